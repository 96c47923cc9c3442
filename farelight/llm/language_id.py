"""Language identification by cross-parsing entropy.

For every language a suffix automaton of a bounded sample of labelled text is built. A text is parsed
greedily into phrases, each the longest match with any place of the sample; a phrase ends where the automaton
has no transition. Phrases, times the bits that point at a place of the sample, estimate the cross entropy of
the text and the language; the language with the fewest of these bits wins.

Texts are lowered, all that is not a letter becomes one blank. Every letter of the samples has codes of its own: one
if it is frequent, up to three in scripts of many signs, so that the tables stay narrow. Parsing starts anew every ``BLOCK`` characters:
so all blocks of a batch, and all languages, advance together as array operations, and a very long
text is only more blocks. Every character of a text is parsed.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelight.llm.tables import batch_map, documents

#: Bounds of what is learned from: characters per language and in all, characters and places per document.
SAMPLE_CHARS = 24_000
TOTAL_CHARS = 240_000
CHARS_PER_DOC = 600

#: Characters that are parsed together, and characters of a batch that are.
BLOCK = 256
SLICE_CHARS = 1 << 20

# Codes: 0 is the blank, then those of letters of the samples, then one for letters that no sample has, then padding.
_WIDTH = 64
_OTHER, _PAD = _WIDTH - 2, _WIDTH - 1
UNKNOWN = "und"


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text modulo 4 is 2."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _codes(texts: list[str], alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts after each other, without repeated blanks, and the length of each text in codes."""
    raw = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    size = np.array([len(r) for r in raw], dtype=np.int64)
    points = np.concatenate(raw) if raw else np.zeros(0, np.uint32)
    codes = alphabet[np.minimum(points, len(alphabet) - 1)]
    kept = np.ones(len(codes), dtype=bool)
    kept[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    begin = np.concatenate([[0], np.cumsum(size)])
    starts = begin[:-1][size > 0]
    kept[starts] = codes[starts] != 0
    if alphabet.dtype == np.uint8:
        total = np.concatenate([[0], np.cumsum(kept)])
        return codes[kept], np.diff(total[begin])
    width = np.where(kept, 1 + (codes > 0xFF) + (codes > 0xFFFF), 0)
    total = np.concatenate([[0], np.cumsum(width)])
    out = np.empty(int(total[-1]), dtype=np.uint8)
    for k in range(3):
        wide = width > k
        out[total[:-1][wide] + k] = (codes[wide] >> (8 * k)) & 0xFF
    return out, np.diff(total[begin])


def _code_lengths(counts: np.ndarray) -> tuple[int, int]:
    """How many codes lead letters of two and of three codes, so that all letters (by falling counts) are shortest in all."""
    codes = _OTHER - 1
    below = np.concatenate([[0], np.cumsum(counts)])
    best = None
    for three in range(codes + 1):
        for two in range(codes + 1 - three):
            ones = codes - two - three
            pairs = ones + two * codes
            if pairs + three * codes**2 >= len(counts):
                cost = 2 * below[-1] - below[min(ones, len(counts))] + below[-1] - below[min(pairs, len(counts))]
                if best is None or cost < best[0]:
                    best = (cost, two, three)
    return best[1:]


def letter_codes(sample: list[str]) -> np.ndarray:
    """The codes of each code point: blank for what is no letter, codes of its own for each letter of the sample.

    Up to three codes are packed into one number, the first one lowest. No letter's codes begin with those of another.
    """
    counts = Counter(c for c in chain.from_iterable(t.lower() for t in sample) if c.isalpha())
    letters = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    codes = _OTHER - 1
    two, three = _code_lengths(np.array([n for _, n in letters], dtype=np.int64))
    table = np.zeros(0x110000, dtype=np.uint32 if two + three else np.uint8)
    table[[p for p in range(len(table)) if chr(p).isalpha()]] = _OTHER
    ones = codes - two - three
    for at, (c, _) in enumerate(letters):
        if at < ones:
            code = at + 1
        elif at < ones + two * codes:
            lead, second = divmod(at - ones, codes)
            code = (ones + 1 + lead) | (second + 1) << 8
        else:
            lead, rest = divmod(at - ones - two * codes, codes**2)
            second, third = divmod(rest, codes)
            code = (ones + two + 1 + lead) | (second + 1) << 8 | (third + 1) << 16
        table[ord(c)] = code
    return table


def automaton(codes: list[int]) -> np.ndarray:
    """The suffix automaton of a sequence as a table for parsing.

    The entry of state * _WIDTH + code is the next state * _WIDTH, plus 1 where a new phrase begins. State 0 is
    the initial one; a code it does not know is a phrase of its own, and padding changes nothing.
    """
    step, link, length = [{}], [-1], [0]
    last = 0
    for c in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] != length[p] + 1:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = clone
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                q = clone
            link[new] = q
        last = new
    root = np.ones(_WIDTH, dtype=np.int32)
    for c, to in step[0].items():
        root[c] = to * _WIDTH + 1
    table = np.tile(root, (len(step), 1))
    table[:, _PAD] = np.arange(len(step)) * _WIDTH
    for state, to in enumerate(step[1:], start=1):
        if to:
            table[state, list(to)] = np.fromiter(to.values(), dtype=np.int64, count=len(to)) * _WIDTH
    return table


def phrases(codes: np.ndarray, size: np.ndarray, tables: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Phrases of each text (rows) by each language (columns); ``tables`` are all tables after each other."""
    blocks = -(-size // BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    begin = np.cumsum(size) - size
    at = np.arange(len(codes)) - np.repeat(begin, size)
    cells = np.full((BLOCK, int(first[-1])), _PAD, dtype=np.uint8)
    cells[at % BLOCK, np.repeat(first[:-1], size) + at // BLOCK] = codes
    state = np.repeat(roots[:, None], cells.shape[1], axis=1)
    count = np.zeros_like(state)
    for row in cells:
        state += row
        state = tables.take(state)
        count += state & 1
        state &= -_WIDTH
    total = np.concatenate([np.zeros((len(roots), 1), np.int64), np.cumsum(count, axis=1, dtype=np.int64)], axis=1)
    return (total[:, first[1:]] - total[:, first[:-1]]).T


def learn(docs: DataFrame, id_column: str, text_column: str, lang_column: str) -> dict[str, list[str]]:
    """Pieces of text per language, all languages within ``TOTAL_CHARS``.

    Rows with smallest hashes of their id and text are taken, and of each a piece whose place depends on the hash too.
    """
    known = docs.filter(F.col(text_column).isNotNull() & F.col(lang_column).isNotNull() & ~held_out(id_column))
    counts = {r[0]: r[1] for r in known.groupBy(lang_column).count().collect()}
    if not counts:
        return {}
    wanted = max(1, min(SAMPLE_CHARS, TOTAL_CHARS // len(counts)) // CHARS_PER_DOC)
    text, lang, key = F.col(text_column), F.col(lang_column), F.xxhash64(id_column)
    # A share of each language that holds about four times the wanted rows, by another hash.
    share = F.create_map(*chain.from_iterable((F.lit(k), F.lit(min(1.0, 4.0 * wanted / n + 0.0))) for k, n in sorted(counts.items())))
    drawn = known.filter(F.pmod(F.xxhash64(F.lit(5), id_column), F.lit(1 << 20)) <= share[lang] * (1 << 20))
    place = 1 + F.pmod(key, F.greatest(F.length(text) - CHARS_PER_DOC, F.lit(1))).cast("int")
    pieces = drawn.select(lang.alias("lang"), key.alias("key"), text.substr(place, F.lit(CHARS_PER_DOC)).alias("piece")).distinct()
    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("key", "piece")))
    rows = ranked.filter(F.col("rank") <= wanted).orderBy("lang", "rank").collect()
    out: dict[str, list[str]] = {}
    for row in rows:
        out.setdefault(row.lang, []).append(row.piece)
    return out


def _predict(sent):
    def run(batches):
        langs, alphabet, tables, roots, bits = sent.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            found, score = [], []
            at = 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end] or "") <= SLICE_CHARS):
                    held += len(texts[end] or "")
                    end += 1
                codes, size = _codes([t or "" for t in texts[at:end]], alphabet)
                total = np.concatenate([[0], np.cumsum(codes > 0)])
                ends = np.cumsum(size)
                letters = total[ends] - total[ends - size]
                if len(langs):
                    cost = phrases(codes, size, tables, roots) * bits
                    best = cost.argmin(axis=1)
                    rest = cost - cost[np.arange(len(cost)), best][:, None]
                    sure = 1 / np.exp2(-np.minimum(rest, 200)).sum(axis=1)
                for i in range(end - at):
                    known = letters[i] > 0 and len(langs) > 0
                    found.append(langs[best[i]] if known else UNKNOWN)
                    score.append(float(sure[i]) if known else 0.0)
                at = end
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.string()), pa.array(score, pa.float64())], names=["_id", "lang_pred", "score"])

    return run


def predict_language(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score`` (0 to 1).

    The score is the winner's share of the weights 2 ** -bits of all languages. Null texts and texts without a
    letter are ``und`` with score 0, as are all when nothing could be learned. Ties go to the smaller
    language. Null ids are carried along and not held out, repeated rows come out repeated, an empty table gives an
    empty result; other columns are not looked at.
    """
    sample = learn(docs, id_column, text_column, lang_column)
    alphabet = letter_codes([t for texts in sample.values() for t in texts])
    langs, built, lengths = [], [], []
    for lang in sorted(sample):
        codes = _codes([" ".join(sample[lang])], alphabet)[0].tolist()
        if codes:
            langs.append(lang), built.append(automaton(codes)), lengths.append(len(codes))
    roots = np.cumsum([0, *[t.size for t in built]], dtype=np.int64)[:-1] if built else np.zeros(0, np.int64)
    tables = np.concatenate([t.ravel() + at.astype(np.int32) for t, at in zip(built, roots, strict=True)]) if built else np.zeros(0, np.int32)
    bits = np.log2(np.array(lengths, dtype=np.float64) + 1)
    sent = docs.sparkSession.sparkContext.broadcast((langs, alphabet, tables, roots.astype(np.int32), bits))
    kind = docs.schema[id_column].dataType.simpleString()
    rows = batch_map(docs.select(id_column, text_column), _predict(sent), f"_id {kind}, lang_pred string, score double")
    return rows.select(F.col("_id").alias(id_column), held_out("_id").alias("held_out"), "lang_pred", "score")


def op2_language_id(spark, sf_dir):
    """The language of every document."""
    return predict_language(documents(spark, sf_dir))
