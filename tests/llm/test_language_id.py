import random

import numpy as np
from pyspark.sql import functions as F

from farelight.llm import language_id


def greedy(sample, text):
    """Phrases by definition: each the longest piece that occurs in the sample, or one unknown code."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and occurs(sample, text[at : end + 1]):
            end += 1
        count, at = count + 1, end
    return count


def occurs(sample, piece):
    return any(sample[i : i + len(piece)] == piece for i in range(len(sample) - len(piece) + 1))


def test_phrases_are_longest_matches():
    random.seed(4)
    samples = [random.choices([0, 1, 2, 3, 4], k=120), random.choices([0, 1, 5, 6], k=90)]
    texts = [random.choices([0, 1, 2, 3, 4, 5, 6, 9], k=n) for n in (1, 2, 40, 255, 256, 257, 700)] + [[]]
    built = [language_id.automaton(s) for s in samples]
    roots = np.array([0, built[0].size], dtype=np.int32)
    tables = np.concatenate([t.ravel() + r for t, r in zip(built, roots, strict=True)])
    codes = np.array([c for t in texts for c in t], dtype=np.uint8)
    found = language_id.phrases(codes, np.array([len(t) for t in texts]), tables, roots)
    for row, text in zip(found, texts, strict=True):
        blocks = [text[i : i + language_id.BLOCK] for i in range(0, len(text), language_id.BLOCK)]
        assert list(row) == [sum(greedy(s, b) for b in blocks) for s in samples]


def test_every_letter_has_codes_of_its_own():
    random.seed(8)
    for n in (0, 1, 61, 62, 70, 900, 5000, 30_000):
        letters = [chr(p) for p in range(0x4E00, 0x9000)][:n] if n < 10_000 else [c for c in map(chr, range(0x3400, 0xD7A4)) if c.isalpha() and c == c.lower()][:n]
        sample = ["".join(letters), "".join(random.choices(letters, k=3000)) if letters else ""]
        table = language_id.letter_codes(sample)
        codes = {tuple(v for k in range(3) if (v := int(table[ord(c)]) >> 8 * k & 255)) for c in letters}
        assert len(codes) == n and max((v for code in codes for v in code), default=0) < language_id._OTHER
        # No letter's codes begin those of another.
        assert not any(code[:k] in codes for code in codes for k in range(1, len(code)))
        assert table[ord("é")] == language_id._OTHER and table[ord("!")] == 0
    text = "".join(letters[:3]) + "!? " + letters[-1] + " "
    coded, size = language_id._codes(["", text, " ", letters[0]], table)
    parts = [[v for k in range(3) if (v := int(table[ord(c)]) >> 8 * k & 255)] for c in letters[:3] + [letters[-1]]]
    expected = sum(parts[:3], []) + [0] + parts[3] + [0]
    assert coded.tolist() == expected + parts[0] and size.tolist() == [0, len(expected), 0, len(parts[0])]


def test_languages_of_one_wide_script_are_told_apart(spark):
    """Two languages with many signs in words of the same lengths, beside two with alphabets."""
    random.seed(9)
    signs = [chr(p) for p in range(0x4E00, 0x4E00 + 1200)]
    vocabulary = {
        "aa": ["".join(random.choices(signs[:800], k=1 + i % 3)) for i in range(600)],
        "bb": ["".join(random.choices(signs[400:], k=1 + i % 3)) for i in range(600)],
        "en": ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=1 + i % 7)) for i in range(600)],
        "ru": ["".join(random.choices([chr(p) for p in range(0x430, 0x450)] + list("éèüöäñçåøæ"), k=1 + i % 7)) for i in range(600)],
    }
    rows = [(i, " ".join(random.choices(vocabulary[lang], k=60)), lang) for i in range(600) for lang in [sorted(vocabulary)[i % 4]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.predict_language(docs).join(docs, "doc_id")
    right = {r[0]: r[1] for r in found.filter("held_out").groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).collect()}
    assert len(right) == 4 and min(right.values()) > 0.97, right


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = language_id.op2_language_id(spark, sf_dir).join(docs, "doc_id")
    right = {r[0]: r[1] for r in found.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).collect()}
    assert right[True] > 0.97 and right[False] > 0.97
    assert found.filter("score < 0 or score > 1").count() == 0


def test_lang_of_held_out_rows_is_not_used(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    first, second = ({tuple(r) for r in language_id.predict_language(d).collect()} for d in (docs, changed))
    assert first == second


def test_odd_rows(odd_docs, odd_rows, no_docs):
    found = language_id.predict_language(odd_docs).collect()
    assert len(found) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in found}
    assert {by_id[i]["lang_pred"] for i in (1, 2, 3, 7)} == {"und"} and by_id[7]["score"] == 0
    assert by_id[6]["lang_pred"] in {"en", "de", "fr"} and not by_id[None]["held_out"]
    assert language_id.predict_language(no_docs).count() == 0
    nothing = language_id.predict_language(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
