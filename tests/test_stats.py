import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelight.operators import stats


@pytest.mark.parametrize("n", [1, 2, 20, 101, 997])
def test_quantiles_are_order_statistics(spark, n):
    random.seed(n)
    values = [round(random.choice([1, 5, 300]) * random.random() - 2, 2) for _ in range(n)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = {r["q"]: r["value"] for r in stats.nearest_quantiles(rows, "v", [0.0, 0.05, 0.5, 0.99, 1.0]).collect()}
    ordered = sorted(values)
    assert got == {q: ordered[math.floor((n - 1) * q + 0.5)] for q in (0.0, 0.05, 0.5, 0.99, 1.0)}


def test_quantiles_of_a_skewed_group(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 100).cast("string")).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("v"),
    )
    got = {(r["g"], r["q"]): r["value"] for r in stats.nearest_quantiles(rows, "v", [0.5], ("g",)).collect()}
    assert got[("hot", 0.5)] == 7.0 and len(got) == 101


SPREADS = {
    "one unit": lambda r: r.random(),
    "many powers": lambda r: r.choice([-1, 1]) * 10 ** r.uniform(-12, 12),
    "ties": lambda r: float(r.randrange(40)),
    "edges": lambda r: r.choice([math.inf, -math.inf, 1.7e308, -1.7e308, 5e-324, 0.0, r.random()]),
}


@pytest.mark.parametrize("spread", SPREADS)
def test_quantiles_by_refinement(spark, monkeypatch, spread):
    """Few values may be ordered at once, so that intervals are narrowed over several passes."""
    monkeypatch.setattr(stats, "ORDERED", 20)
    monkeypatch.setattr(stats, "FAN", 64)
    r = random.Random(spread)
    values = [(g, SPREADS[spread](r)) for g, n in (("a", 400), ("b", 7), ("c", 1)) for _ in range(n)]
    odd = [("a", None), ("a", math.nan), (None, 1.0), ("d", None)]
    rows = spark.createDataFrame(values + odd, "g string, v double").repartition(3)
    wanted = [0.0, 0.05, 0.5, 0.51, 0.99, 1.0]
    got = {(x["g"], x["q"]): (x["value"], x["n"]) for x in stats.nearest_quantiles(rows, "v", wanted, ("g",)).collect()}
    for g in "abc":
        ordered = sorted(v for k, v in values if k == g)
        for q in wanted:
            assert got.pop((g, q)) == (ordered[math.floor((len(ordered) - 1) * q + 0.5)], len(ordered))
    assert not got


def test_quantiles_order_few_values_per_task(spark, monkeypatch):
    """A continuous column inside one unit: what is ordered stays within the bound."""
    monkeypatch.setattr(stats, "ORDERED", 500)
    made = []
    monkeypatch.setattr(stats, "broadcast_if_small", lambda df: made.append(df) or df)
    rows = spark.range(40_000).select((F.pmod(F.xxhash64("id"), F.lit(10**15)) / 1e15).alias("v"))
    assert stats.nearest_quantiles(rows, "v", [0.05, 0.5]).count() == 2
    last = made[-1].collect()
    assert len(last) == 2 and all(1 <= x["distinct"] <= 500 for x in last)
    assert stats.nearest_quantiles(rows.limit(0), "v", [0.5]).count() == 0


def test_trim_keeps_both_bounds(spark):
    rows = spark.range(101).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("c"))
    kept = sorted(r["v"] for r in stats.quantile_trim(rows, "v").collect())
    assert kept == [float(i) for i in range(5, 100)]
    assert stats.quantile_trim(rows, "v", ("c",)).count() == len(kept)


def test_metrics(spark):
    y, p = np.array([1.0, 2.0, 4.0, 8.0]), np.array([1.5, 1.5, 4.5, 7.0])
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, prediction double")
    m = stats.regression_metrics(rows, "y").first()
    e = y - p
    assert m["rmse"] == pytest.approx(math.sqrt((e**2).mean()))
    assert m["mae"] == pytest.approx(abs(e).mean())
    assert m["r2"] == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())


def test_histogram_and_density(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(0, 2, 500)
    rows = spark.createDataFrame([(float(v),) for v in values], "residual double")
    counts = np.histogram(values, bins=30)[0]
    got = {r["bin"]: r["n"] for r in stats.residual_histogram(rows).collect()}
    assert [got.get(i, 0) for i in range(30)] == counts.tolist()
    curve = stats.residual_kde(rows).collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    for r in curve:
        expected = np.exp(-0.5 * ((values - r["x"]) / h) ** 2).sum() / (len(values) * h * math.sqrt(2 * math.pi))
        assert abs(r["density"] - expected) <= stats.KDE_STEP**2 / 8 / (h * math.sqrt(2 * math.pi))
    coarse = stats.residual_kde(rows, step=1.0).collect()
    assert max(abs(a["density"] - b["density"]) for a, b in zip(curve, coarse, strict=True)) <= (1 + stats.KDE_STEP**2) / 8 / (h * math.sqrt(2 * math.pi))


def test_histogram_of_equal_values(spark):
    rows = spark.createDataFrame([(1.0,)] * 5, "residual double")
    assert [(r["bin"], r["n"]) for r in stats.residual_histogram(rows).collect()] == [(0, 5)]
