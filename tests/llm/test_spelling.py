import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from farelight.llm import spelling


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_vocabulary(rows, length=6, count=5, every=199):
    found = Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(word)
            h = crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= length and n >= count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words, factor=5):
    near = {w: [v for v in words if v != w and one_edit(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def variants(seed, letters="aábcdeéx", n=60):
    """Words with changed forms of them, in chains, of a few letters."""
    random.seed(seed)
    words = {}
    for _ in range(n):
        word = "".join(random.choices(letters, k=random.randint(6, 9)))
        count = 4000
        while count > 5:
            words[word] = count
            count //= random.choice([3, 6, 7])
            at = random.randrange(len(word))
            word = random.choice([word[:at] + word[at + 1 :], word[:at] + random.choice(letters) + word[at:], word[:at] + random.choice(letters) + word[at + 1 :]])
    return {w: n for w, n in words.items() if len(w) >= 6}


def found_groups(spark, words, **options):
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = spelling.spelling_groups(frame, **options).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("symbols", [1, 2, 8, 26])
def test_groups_by_all_pairs(spark, symbols):
    words = variants(symbols)
    expected = brute_groups(words)
    assert sum(r[1] is not None for r in expected) > 20 and any(r[1] not in (None, r[2]) for r in expected)
    assert found_groups(spark, words, symbols=symbols) == expected


def test_ties_long_words_and_nothing(spark):
    long = "ab" * 20_000
    words = {"zebraa": 1, "zebrab": 7, "zebrac": 7, "aaaaaa": 1, "aaaaaaa": 5, long: 9, long[:-1]: 1, long + "é": 2, "ÀÀÀÀÀÀ": 4, "ÀÀÀÀÀà": 40}
    found = {r[0]: r for r in found_groups(spark, words)}
    assert found["zebraa"][1:] == ("zebrab", "zebrab", 1, 2, 7) and found["aaaaaa"][1] == "aaaaaaa"
    assert found[long[:-1]][1:] == (long, long, 1, 1, 9) and found[long + "é"][1] is None and found[long][4] == 2
    assert found["ÀÀÀÀÀÀ"][1] == "ÀÀÀÀÀà"
    assert found_groups(spark, {}) == []


@pytest.mark.parametrize("symbols", [1, 3])
def test_neighbourhood_is_whole_and_without_repeats(symbols):
    random.seed(symbols)
    letters = "abcdefgh"[:symbols]
    reduced = ["".join(random.choices(letters, k=k)) for k in (1, 2, 5, 6, 9, 9)] + ["aaaaaa"]
    made = [[] for _ in reduced]
    for owner, keys in spelling.neighbour_keys(reduced, symbols):
        for i, k in zip(owner.tolist(), keys.tolist()):
            made[i].append(k)
    for word, keys in zip(reduced, made):
        around = {word[:i] + word[i + 1 :] for i in range(len(word))}
        around |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters} - {word}
        around |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
        wanted = [int(spelling.keys_of([x])[0]) if x else int(spelling.keys_of(["", "a"])[0]) for x in around]
        assert sorted(keys) == sorted(wanted)


@pytest.mark.parametrize("held", [spelling.HELD_WORDS, 3])
def test_vocabulary(spark, monkeypatch, held):
    monkeypatch.setattr(spelling, "HELD_WORDS", held)
    random.seed(held)
    pool = ["Straße", "strasse", "letters", "LETTERS", "Été", "abcdefg", "ÀÉÎabc", "a×b÷cdef", "naïveté", "word1word2", "x" * 3000]
    rows = [(i if i % 9 else None, " ".join(random.choices(pool, k=random.randint(0, 30)))) for i in range(300)] + [(7, None), (None, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for every in (199, 2):
        found = {r["word"]: r["n"] for r in spelling.vocabulary(docs, every=every).collect()}
        assert found == brute_vocabulary(rows, every=every)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    found = {r["word"]: r["n"] for r in spelling.vocabulary(odd_docs).collect()}
    assert found == brute_vocabulary([r[:2] for r in odd_rows]) and "straße" in found
    assert spelling.vocabulary(no_docs).count() == 0


def test_registered_query_by_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(tuple(r) for r in spelling.op13_spelling_variants(spark, sf_dir).collect())
    assert found == brute_groups(brute_vocabulary(rows)) and len(found) > 500


def test_letters_are_spread_over_the_symbols():
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    counts = np.bincount([ord(c) - 97 for c in spelling.reduce_words(letters, 8)], minlength=8)
    assert counts.max() <= 24 and (counts > 0).all()
