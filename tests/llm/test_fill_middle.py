import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelight.llm import fill_middle
from farelight.llm.fill_middle import ChunkCache, ChunkedText, chunk_ends, fill_in_middle, restored


def transformed(doc_id, text, rate=100, spm=50):
    """The definition."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), form, len(prefix), len(middle), output


def texts(seed):
    random.seed(seed)
    passages = ["".join(random.choices("aé文🚕 b\n<PSM>", k=random.randint(1, 3000))) for _ in range(12)]
    made = ["".join(random.choices([*passages, "\n", "x\n", "é"], k=random.randint(0, 6))) for _ in range(250)]
    return made + ["", "\n", "\n\n", "a", "a\n", "\na", "<P>", "x<M", "<S>y\n", None, "y" * 40_000 + "\nz", "<" * 3000 + "P>"]


def rows_of(df):
    key = lambda r: (str(r[0]), r[1], str(r[-1]))
    return sorted((tuple(r) for r in df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=key)


@pytest.mark.parametrize("cache", [fill_middle.CACHE_BYTES, 2000])
@pytest.mark.parametrize("rate,spm", [(100, 50), (40, 0), (100, 100)])
def test_definition_and_round_trip(spark, cache, rate, spm):
    rows = list(enumerate(texts(rate + spm)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = fill_in_middle(docs, rate=rate, spm=spm, cache_bytes=cache)
    expected = [(i, *transformed(i, t, rate, spm)) for i, t in rows]
    assert rows_of(found) == sorted(expected, key=lambda r: (str(r[0]), r[1], str(r[-1])))
    back = {r["doc_id"]: r["t"] for r in found.select("doc_id", restored("output", "form").alias("t")).collect()}
    assert back == {i: t or "" for i, t in rows}


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    found = fill_in_middle(odd_docs)
    expected = sorted(((r[0], *transformed(r[0], r[1])) for r in odd_rows), key=lambda r: (str(r[0]), r[1], str(r[-1])))
    assert rows_of(found) == expected
    assert fill_in_middle(no_docs).count() == 0


def test_chunks_follow_the_content():
    random.seed(3)
    shared = bytes(random.choices(range(97, 123), k=20_000))
    whole = [b"start one " + shared + b" end", b"another, longer start of it " + shared + b"!", shared, b"", b"short"]
    data = np.frombuffer(b"".join(whole), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, whole)])
    ends = chunk_ends(data, offsets)
    cut = [{whole[i][s - offsets[i] : e - offsets[i]] for s, e in zip([offsets[i], *part[:-1]], part)} for i, part in enumerate(ends)]
    assert all(b"".join(whole[i][s - offsets[i] : e - offsets[i]] for s, e in zip([offsets[i], *p[:-1]], p)) == whole[i] for i, p in enumerate(ends))
    assert len(cut[0] & cut[1] & cut[2]) > 25 and ends[3] == [] and len(ends[4]) == 1
    # Alone, each text is cut in the same way.
    for text, part, start in zip(whole, ends, offsets):
        assert [e - start for e in part] == chunk_ends(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))[0]


def test_shared_chunks_are_summarised_once():
    cache = ChunkCache((b"<P>",))
    random.seed(4)
    text = bytes(random.choices(b"abc\n", k=30_000))
    ends = chunk_ends(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))[0]
    first = ChunkedText(text, ends, cache)
    misses = cache.misses
    assert ChunkedText(text, ends, cache).lines == first.lines and cache.misses == misses > 20 and cache.hits >= misses
    small = ChunkCache((b"<P>",), 1000)
    assert ChunkedText(text, ends, small).lines == first.lines
    assert sum(map(len, small.young)) + sum(map(len, small.old)) <= 2 * 1000 + 2 * fill_middle.LONGEST_CHUNK


def test_sentinel_over_a_chunk_end():
    cache = ChunkCache((b"<P>", b"<S>", b"<M>"))
    text = b"one line\nmore <P> text\n"
    for cut in range(1, len(text)):
        assert ChunkedText(text, [cut, len(text)], cache).marked


def test_sentinels_that_cannot_be_told_apart(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for wrong in (("<P>", "<P>", "<M>"), ("<P>", "<P>x", "<M>"), ("<P<", "<S>", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle(docs, sentinels=wrong)
    found = fill_in_middle(docs, sentinels=("[a]", "{s}", "|m")).select(restored("output", "form", ("[a]", "{s}", "|m")).alias("t"), F.col("output"))
    assert found.first()["t"] == "a"
