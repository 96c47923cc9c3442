import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

#: Columns of other tables or of the operators' own making; no operator may trip over them.
EXTRA = "n long, label string, _id long, _hash long, score double, shard int, virtual_slot int, _statistics string, _row_id long, text_hash long, size long, h long, _source string, _mix_h long, lang_pred string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 5000} Straße" for i in range(60_000))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n", "de", None, 3), (None, "no id here at all today", "en", "b", 5),
        (4, "the same text for two ids and more", "en", "a", 1), (5, "the same text for two ids and more", "en", "b", 1),
        (6, long, "de", "b", 9), (7, "!!! 123 ???", None, "c", 1), (8, "x", "en", "c", 1), (9, "Ünïcödé 🚕 文字 words", "fr", "é", 1),
        (4, "the same text for two ids and more", "en", "a", 1), (4, "the same text for two ids and more", "en", "a", 1),
        (None, None, None, None, None), (None, None, None, None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    extra = ", ".join(f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in EXTRA.split(", "))
    return spark.createDataFrame(odd_rows, DOCS).selectExpr("*", *extra.split(", ")).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
