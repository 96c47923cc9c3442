import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farelight.llm import quality_rules


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_statistics_by_hand():
    text = "Ab cd cd!! 12\n\nÉ## cd"
    found = dict(zip(quality_rules.STATISTICS, quality_rules.statistics(pa.array(["zzz", None, text, ""]))[2], strict=True))
    data, words = text.encode(), text.split()
    assert found["n_words"] == 6 and found["n_bytes"] == len(data) and found["n_lines"] == 2
    assert found["upper"] == pytest.approx(1 / len(data)) and found["digit"] == pytest.approx(2 / len(data))
    assert found["beyond"] == pytest.approx(2 / len(data)) and found["marks"] == pytest.approx(2 / len(data))
    assert found["distinct_words"] == pytest.approx(5 / 6) and found["top_word"] == pytest.approx(2 / 6)
    assert found["bare_words"] == pytest.approx(1 / 6) and found["sign_words"] == pytest.approx(2 / 6)
    assert found["word_bytes"] == pytest.approx(sum(len(w.encode()) for w in words) / 6) and found["longest_word"] == 4
    assert found["line_words"] == 3 and found["longest_line"] == len(b"Ab cd cd!! 12")
    assert not quality_rules.statistics(pa.array([None, ""]))[0].any()


def test_held_out_rows_are_ranked_well(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = quality_rules.op10_quality_classifier(spark, sf_dir)
    found = scores.join(labels.filter("quality is not null"), "doc_id").toPandas()
    held = found[found.held_out]
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.97
    assert (held.predicted == held.quality).mean() > 0.95
    assert scores.filter("score < 0 or score > 1 or score is null").count() == 0
    assert scores.filter("predicted <> cast(score >= 0.3 as int)").count() == 0


def test_labels_of_held_out_rows_are_not_used(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    changed = labels.withColumn("quality", F.when(quality_rules.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    moved = docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")})
    first, second = ({tuple(r) for r in quality_rules.quality_scores(d, x).collect()} for d, x in ((docs, labels), (moved, changed)))
    assert first == second


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    some = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (6, 1, None), (8, 0, 1), (None, 1, 1), (9, 7, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    for labels in (some, some.limit(0), some.filter("quality = 1")):
        found = quality_rules.quality_scores(odd_docs, labels).collect()
        assert len(found) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in found)
    assert {r["score"] for r in quality_rules.quality_scores(odd_docs, some.limit(0)).collect()} == {0.5}
    kept = quality_rules.keep_good(odd_docs, some.limit(0))
    assert kept.count() == len(odd_rows) and kept.columns == odd_docs.columns
    assert quality_rules.quality_scores(no_docs, some).count() == 0 == quality_rules.keep_good(no_docs, some).count()
