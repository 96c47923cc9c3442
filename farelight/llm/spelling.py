"""Spelling variants by one-edit neighbourhoods over a reduced alphabet.

1. A pass over the texts counts words; a task adds up what it has read before anything is shuffled.
2. Letters are hashed to a few symbols. Two words that differ by one edit have reduced words that are equal or differ by
   one edit. A reduced word has fewer neighbours than a word, as there are few symbols to insert or to put in place of another.
3. Every distinct reduced word generates its whole one-edit neighbourhood, as 64-bit keys computed from prefix sums. Of two
   neighbours, the one with the smaller key generates the other, so nothing is generated twice.
4. Keys are joined with those of the reduced vocabulary; the words behind two keys that meet are compared as they are.

Keys that coincide by chance only give words to compare.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelight.llm.tables import batch_map, documents, hint_small
from farelight.llm.words import mix
from farelight.session import materialize

#: Symbols that letters are hashed to.
SYMBOLS = 8

#: Words a task holds counts of before it passes them on.
HELD_WORDS = 200_000

_BASE = 0xD6E8FEB86659FD93
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_BASE = np.uint64(_BASE)


def _count(least: int, every: int):
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def passed(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches):
        counts: dict[str, int] = defaultdict(int)
        for batch in batches:
            texts = pc.ascii_lower(batch.column(1)).to_pylist()
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                if not text:
                    continue
                start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs.findall(text)).items():
                    h = crc32(word.encode(), start)
                    if every and h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    counts[word] += n
            if len(counts) > HELD_WORDS:
                yield passed(counts)
                counts.clear()
        yield passed(counts)

    return run


def vocabulary(
    docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int = 199, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Words of at least so many code points and occurrences with their number: rows (word, n).

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lowered. A run whose CRC-32, taken with the id of its document, is
    divisible by ``every`` loses one code point (0: none does). Null texts have no words; a null id counts as the empty text.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    counted = batch_map(rows, _count(least_length, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _flat(reduced: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words one after the other, from 1, and the start of each word."""
    letters = np.frombuffer("".join(reduced).encode("ascii"), dtype=np.uint8).astype(np.uint64) - np.uint64(96)
    return letters, np.concatenate([[0], np.cumsum([len(w) for w in reduced])]).astype(np.int64)


def _sums(letters: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Position powers and, per letter, the sum of the letters before it in its word; the sum of each word; its length's power."""
    lengths = np.diff(begin)
    longest = int(lengths.max(initial=0)) + 1
    powers = np.full(longest + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    power = powers[np.arange(len(letters)) - begin[owner]]
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * power)])
    before = running[:-1] - running[begin[owner]]
    return owner, power, before, running[begin[1:]] - running[begin[:-1]], powers[lengths]


def keys_of(reduced: list[str]) -> np.ndarray:
    """A 64-bit key of each reduced word."""
    with np.errstate(over="ignore"):
        letters, begin = _flat(reduced)
        return mix(_sums(letters, begin)[3]).view(np.int64)


def neighbour_keys(reduced: list[str], symbols: int):
    """Keys of all words one edit away, in parts: arrays of the index of the word and the key, each key once per word.

    Deleting any of some equal neighbouring symbols gives one word, and so does inserting another of them.
    """
    with np.errstate(over="ignore"):
        letters, begin = _flat(reduced)
        owner, power, before, total, end_power = _sums(letters, begin)
        if not len(letters):
            return
        previous = np.concatenate([np.zeros(1, np.uint64), letters[:-1]])
        previous[begin[:-1][np.diff(begin) > 0]] = 0
        after = total[owner] - before - letters * power
        keep = letters != previous
        yield owner[keep], mix(before + after * _INVERSE)[keep].view(np.int64)
        filled = np.flatnonzero(np.diff(begin))
        last = letters[begin[filled + 1] - 1]
        for symbol in range(1, symbols + 1):
            s = np.uint64(symbol)
            keep = letters != s
            yield owner[keep], mix(total[owner] + (s - letters) * power)[keep].view(np.int64)
            keep = previous != s
            yield owner[keep], mix(before + s * power + (total[owner] - before) * _BASE)[keep].view(np.int64)
            keep = last != s
            yield filled[keep], mix(total[filled] + s * end_power[filled])[keep].view(np.int64)


def reduce_words(words: list[str], symbols: int) -> list[str]:
    """Each letter as one of the first ``symbols`` small letters, by a hash."""
    table: dict[int, int] = {}
    for code in {ord(c) for w in words for c in w}:
        table[code] = 97 + int(mix(np.array([code], dtype=np.uint64))[0] % np.uint64(symbols))
    return [w.translate(table) for w in words]


def _reduced(symbols: int):
    def run(batches):
        for batch in batches:
            reduced = reduce_words(batch.column("word").to_pylist(), symbols)
            columns = [*batch.columns, pa.array(reduced, pa.string()), pa.array(keys_of(reduced), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "reduced", "key"])

    return run


def _neighbours(symbols: int):
    def run(batches):
        for batch in batches:
            reduced, own = batch.column("reduced").to_pylist(), batch.column("key").to_numpy()
            for owner, keys in neighbour_keys(reduced, symbols):
                low = own[owner]
                above = keys > low
                yield pa.RecordBatch.from_arrays([pa.array(low[above]), pa.array(keys[above])], names=["low", "key"])

    return run


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Pairs of words of a written vocabulary (word, n) that differ by exactly one edit: rows (a, n_a, b, n_b), each pair once."""
    words = materialize(batch_map(vocabulary, _reduced(symbols), "word string, n long, reduced string, key long"), "reduced")
    # Two reduced words of one key, should there be any, both generate their neighbours.
    shapes = materialize(words.select("reduced", "key").distinct(), "shapes")
    known = hint_small(materialize(shapes.select("key").distinct(), "known"))
    made = batch_map(shapes, _neighbours(symbols), "low long, key long")
    meet = materialize(made.join(known, "key").distinct(), "meet")
    sides = {s: words.select(F.col("word").alias(s), F.col("n").alias(f"n_{s}"), F.col("key").alias(f"key_{s}")) for s in "ab"}
    equal = sides["a"].join(sides["b"], (F.col("key_a") == F.col("key_b")) & (F.col("a") < F.col("b")))
    other = sides["a"].join(meet, F.col("key_a") == F.col("low")).join(sides["b"], F.col("key_b") == F.col("key"))
    pairs = equal.select("a", "n_a", "b", "n_b").union(other.select("a", "n_a", "b", "n_b"))
    return pairs.filter(F.levenshtein("a", "b", 1) == 1)


def spelling_groups(vocabulary: DataFrame, factor: int = 5, symbols: int = SYMBOLS) -> DataFrame:
    """Per word of a vocabulary (word, n): ``n_near`` words one edit away, ``form``, ``form_n`` and ``root``.

    The form is the near word of largest n (ties: the smallest in code-point order) if that is at least ``factor`` times the
    word's; else null. The root is where following forms ends, the word itself if it has none; n grows along the way, so it
    ends. An empty vocabulary gives an empty result.
    """
    words = materialize(vocabulary.select("word", "n"), "vocabulary")
    pairs = materialize(near_words(words, symbols), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))
    formed = words.join(best, "word", "left")
    close = F.col("form_n") >= factor * F.col("n")
    formed = materialize(
        formed.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(close, F.col("form")).alias("form"), F.when(close, F.col("form_n")).alias("form_n"),
        ),
        "formed",
    )
    # Pointers double their reach in every round.
    ways = materialize(formed.filter("form is not null").select("word", F.col("form").alias("root")), "ways")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(
            ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "ways",
        )
        ways = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return formed.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark, sf_dir):
    """Words of all documents with their near words, forms and roots."""
    found = spelling_groups(vocabulary(documents(spark, sf_dir)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


OP13_SQL = """
    WITH RECURSIVE runs AS (
      SELECT doc_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{6,}')) AS run
      FROM documents),
    counted AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL),
    -- CRC-32 of the UTF-8 bytes, bit by bit; no character here is beyond two bytes.
    spelled AS (
      SELECT run, c, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
               ELSE [192 + unicode(x)::BIGINT // 64, 128 + unicode(x)::BIGINT % 64] END)) AS bytes
      FROM counted),
    hashed AS (
      SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda s, b:
               list_reduce(list_prepend(xor(s, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h
      FROM spelled),
    words AS (
      SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c
      FROM hashed),
    vocabulary AS (SELECT word, sum(c)::BIGINT AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary),
    masked AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask FROM places),
    shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM places),
    near AS (
      SELECT a.word, b.word AS other, b.n AS other_n FROM masked a JOIN masked b ON a.mask = b.mask AND a.word <> b.word
      UNION ALL SELECT s.word, v.word, v.n FROM shorter s JOIN vocabulary v ON s.short = v.word
      UNION ALL SELECT v.word, s.word, s.n FROM shorter s JOIN vocabulary v ON s.short = v.word),
    ranked AS (
      SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
             row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r
      FROM near),
    formed AS (
      SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
             CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
      FROM vocabulary v LEFT JOIN ranked k ON k.word = v.word AND r = 1),
    ways AS (
      SELECT word, word AS there, 0 AS step FROM formed
      UNION ALL SELECT ways.word, f.form, step + 1 FROM ways JOIN formed f ON f.word = ways.there WHERE f.form IS NOT NULL)
    SELECT word, form, root, n, n_near, form_n
    FROM formed JOIN (SELECT word, arg_max(there, step) AS root FROM ways GROUP BY word) USING (word)"""
