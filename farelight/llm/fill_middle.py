"""Fill-in-middle transformation by memoised content-defined chunks.

A text is cut into line units; two hashed cuts part it into prefix, middle and suffix, which are put in another order
between sentinels. Cuts are found from summaries of chunks:

1. A rolling hash over the last 16 bytes ends a chunk wherever its leading bits are zero. Chunk ends follow the content, so
   a passage that stands in many documents is cut into the same chunks, wherever it stands.
2. A task keeps the boundary summary of each chunk it has seen: line ends, code points, whether it ends with a
   line end, whether it holds a sentinel. The chunk's bytes are the key, so a hit is equal in content. The cache
   keeps two generations of bounded size; what it forgets is summarised again.
3. Sums of the summaries give the number of units and the chunk of each cut; only that chunk is looked into. A sentinel may
   reach over a chunk end, so the few bytes around it are looked at too.

Nothing is shuffled; a task holds one batch of texts and the cache.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelight.llm import words
from farelight.llm.tables import batch_map, documents

#: Chunks have 2**CHUNK_BITS bytes on average and LONGEST_CHUNK at most.
CHUNK_BITS = 9
LONGEST_CHUNK = 1 << 14

#: Bytes of chunks in one of the two generations of a task's cache.
CACHE_BYTES = 32 << 20

SENTINELS = ("<P>", "<S>", "<M>")

_WINDOW = 16
_GEAR = np.random.Generator(np.random.PCG64(977)).integers(0, 2**32, 256, dtype=np.uint32)
_CONTINUES = bytes(range(0x80, 0xC0))


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """For each text of a slice the ends of its chunks in ``data``; an empty text has none.

    Ends depend on the bytes of the text alone, not on its neighbours: within a window of its start there is none.
    """
    rolled = _GEAR[data]
    step = 1
    while step < _WINDOW:
        longer = rolled.copy()
        longer[step:] += rolled[:-step] << np.uint32(step)
        rolled, step = longer, 2 * step
    found = np.flatnonzero(rolled >> np.uint32(32 - CHUNK_BITS) == 0) + 1
    out = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        inner = found[np.searchsorted(found, start + _WINDOW) : np.searchsorted(found, end)].tolist()
        ends, last = [], start
        for cut in [*inner, end]:
            while cut - last > LONGEST_CHUNK:
                last += LONGEST_CHUNK
                ends.append(last)
            if cut > last:
                ends.append(cut)
                last = cut
        out.append(ends)
    return out


def code_points(piece: bytes) -> int:
    """Code points that start in a piece of UTF-8; sums over any cutting of a text are its length."""
    return len(piece.translate(None, _CONTINUES))


class ChunkCache:
    """Boundary summaries of chunks by their content, in two generations of bounded size."""

    def __init__(self, sentinels: tuple[bytes, ...], limit: int = CACHE_BYTES):
        self.sentinels, self.limit = sentinels, limit
        self.young: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}
        self.held = self.hits = self.misses = 0

    def summary(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        """Line ends, code points, whether the last byte is a line end, whether a sentinel is inside."""
        found = self.young.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self.old.get(chunk)
        if found is None:
            self.misses += 1
            found = (chunk.count(b"\n"), code_points(chunk), chunk.endswith(b"\n"), any(s in chunk for s in self.sentinels))
        else:
            self.hits += 1
        if self.held + len(chunk) > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[chunk] = found
        self.held += len(chunk)
        return found


class ChunkedText:
    """A text as its chunks' summaries."""

    def __init__(self, text: bytes, ends: list[int], cache: ChunkCache):
        self.text, self.ends, starts = text, ends, [0, *ends][:-1]
        found = [cache.summary(text[s:e]) for s, e in zip(starts, ends, strict=True)]
        self.lines = list(accumulate(f[0] for f in found))
        self.points = list(accumulate(f[1] for f in found))
        self.units = self.lines[-1] + (not found[-1][2]) if found else 0
        reach = max(map(len, cache.sentinels), default=1) - 1
        self.marked = any(f[3] for f in found) or any(
            any(s in text[max(0, e - reach) : e + reach] for s in cache.sentinels) for e in ends[:-1]
        )

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` line units."""
        if not units:
            return 0, 0
        if units > self.lines[-1]:
            return self.ends[-1], self.points[-1]
        k = bisect_left(self.lines, units)
        at = start = self.ends[k - 1] if k else 0
        for _ in range(units - (self.lines[k - 1] if k else 0)):
            at = self.text.index(b"\n", at) + 1
        return at, (self.points[k - 1] if k else 0) + code_points(self.text[start:at])


def _transform(seed: str, rate: int, spm: int, sentinels: tuple[str, str, str], limit: int):
    marks = tuple(s.encode() for s in sentinels)
    prefix_mark, suffix_mark, middle_mark = marks

    def run(batches):
        cache = ChunkCache(marks, limit)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, end, data, offsets in words.text_slices(batch.column(1)):
                whole, at = data.tobytes(), offsets.tolist()
                out: list[list] = [[], [], [], [], []]
                for i, ends in enumerate(chunk_ends(data, offsets)):
                    text = whole[at[i] : at[i + 1]]
                    doc = ChunkedText(text, [e - at[i] for e in ends], cache)
                    name = "" if ids[row + i] is None else str(ids[row + i])
                    h = struct.unpack(">4I", hashlib.sha256(f"{seed}:{name}".encode()).digest()[:16])
                    if not text or doc.marked or h[2] % 100 >= rate:
                        result = (doc.units, "plain", None, None, text)
                    else:
                        low, high = sorted((h[0] % (doc.units + 1), h[1] % (doc.units + 1)))
                        (a, a_points), (b, b_points) = doc.cut(low), doc.cut(high)
                        prefix, middle, suffix = text[:a], text[a:b], text[b:]
                        if h[3] % 100 < spm:
                            form, parts = "spm", (suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle)
                        else:
                            form, parts = "psm", (prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle)
                        result = (doc.units, form, a_points, b_points - a_points, b"".join(parts))
                    for column, value in zip(out, result, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, end - row),
                        pa.array(out[0], pa.int64()),
                        pa.array(out[1], pa.string()),
                        pa.array(out[2], pa.int64()),
                        pa.array(out[3], pa.int64()),
                        pa.array(out[4], pa.binary()).cast(pa.string()),
                    ],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(
    docs: DataFrame,
    seed: str = "7",
    rate: int = 100,
    spm: int = 50,
    sentinels: tuple[str, str, str] = SENTINELS,
    id_column: str = "doc_id",
    text_column: str = "text",
    cache_bytes: int = CACHE_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n`` line units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Cuts and form follow from SHA-256 of ``seed:id``, so reruns agree. ``rate`` of 100 documents are transformed, ``spm`` of 100 of these
    with the suffix first. The form is ``plain``, and the output the text, for a text that is null (as if empty), empty or
    holds a sentinel, and for documents beyond the rate. ``restored`` gives the text back.

    A null id counts as the empty text; rows that share an id get the same hashes, equal rows the same output. A text
    without a line end is one unit, a blank one too; a very long one is only more chunks. An empty table gives an empty
    result. Other columns are not looked at.
    """
    first = {s[:1] for s in sentinels}
    if any(first & set(s[1:]) or sum(t.startswith(s) for t in sentinels) > 1 for s in sentinels):
        raise ValueError("no sentinel may begin another one, and none may hold a first character at a later place")
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    run = _transform(seed, rate, spm, tuple(sentinels), cache_bytes)
    found = batch_map(rows, run, f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")
    return found.withColumnRenamed("id", id_column)


def restored(output: Column | str, form: Column | str, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``fill_in_middle`` made this output and form of.

    No part holds a sentinel, and none can arise where a part and a sentinel meet.
    """
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    prefix, suffix, middle = (f"\\Q{s}\\E" for s in sentinels)
    psm = F.split(output, f"{prefix}|{suffix}|{middle}", -1)
    return F.when(form == "psm", F.concat(psm[1], psm[3], psm[2])).when(form == "spm", F.concat(psm[2], psm[3], psm[1])).otherwise(output)


def op12_fill_in_middle(spark, sf_dir):
    """Digests of the transformed documents and of the texts rebuilt from them."""
    found = fill_in_middle(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )


OP12_SQL = """
    WITH units AS (
      SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
             sha256('7:' || doc_id) AS h
      FROM documents),
    hashed AS (
      SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[25:32])::BIGINT AS h4
      FROM units),
    cut AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
      FROM hashed),
    parts AS (
      SELECT doc_id, n, t, form, array_to_string(u[1 : lo], '') AS p,
             array_to_string(u[lo + 1 : hi], '') AS m, array_to_string(u[hi + 1 : n], '') AS s
      FROM cut)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM parts"""
