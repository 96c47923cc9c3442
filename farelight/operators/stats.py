"""Quantiles, error metrics and residual distributions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farelight.session import broadcast_if_small, materialize

# The quantiles outliers are cut at, and the bins of a residual plot.
TRIM_LOW, TRIM_HIGH = 0.05, 0.99
RESIDUAL_BINS = 30

#: Step of the grid residuals are shared out on, in bandwidths.
KDE_STEP = 1 / 32

#: Distinct values that one task may order for a quantile, and bins an interval with more is cut into.
ORDERED = 100_000
FAN = 4096


def count_where(df: DataFrame, conditions: dict) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def _closer(counts: DataFrame, open_: DataFrame, key: list[str]) -> DataFrame:
    """Each open interval of ``open_`` narrowed to the bin that holds its rank.

    An interval is cut into ``FAN`` bins of equal width; its least and its greatest value have bins of their own, so every pass leaves
    out a value at least, infinities at once. Two ranks of one interval share its bins.
    """
    spans = open_.select(*key, "low", "high").distinct()
    inside = counts.join(broadcast_if_small(spans), key).filter(F.col("_value").between(F.col("low"), F.col("high")))
    low, high, value = (F.col(c).cast("double") / 2 for c in ("low", "high", "_value"))
    position = F.floor(F.try_divide(value - low, high - low) * (FAN - 2))
    bin_ = (
        F.when(F.col("_value") == F.col("low"), 0).when(F.col("_value") == F.col("high"), FAN)
        .otherwise(F.least(F.greatest(F.coalesce(position, F.lit(0)) + 1, F.lit(1)), F.lit(FAN - 1)))
    )
    bins = inside.groupBy(*key, "low", "high", bin_.alias("_bin")).agg(
        F.sum("_n").alias("_n"), F.count("*").alias("distinct"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
    )
    earlier = W.partitionBy(*key, "low", "high").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("_skipped", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_bin")
    found = bins.join(broadcast_if_small(open_.select(*key, "q", "rank", "n", "before", "low", "high")), [*key, "low", "high"])
    start = F.col("before") + F.col("_skipped")
    found = found.filter((start <= F.col("rank")) & (F.col("rank") < start + F.col("_n")))
    return found.select(*key, "q", "rank", "n", start.alias("before"), F.col("_low").alias("low"), F.col("_high").alias("high"), "distinct")


def nearest_quantiles(df: DataFrame, value: str, quantiles: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """Exact order statistics: the value of rank floor((n-1)*q + 0.5), per group.

    Rows (*by, q, value, n). Nulls and NaN count as missing, groups whose key is null have no row. Values are counted before they are
    shuffled, and the counts are written once. The interval that holds a rank is narrowed pass by pass to a bin of it, until it has
    at most ``ORDERED`` distinct values; only these are ordered. No task orders more, however values are spread, and
    a pass makes ``FAN`` bins per interval.
    """
    key = list(by) or ["_all"]
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    rows = rows if by else rows.withColumn("_all", F.lit(1))
    counts = materialize(rows.groupBy(*key, F.col(value).alias("_value")).agg(F.count("*").alias("_n")), "value_counts")
    whole = counts.groupBy(*key).agg(
        F.sum("_n").alias("n"), F.count("*").alias("distinct"), F.min("_value").alias("low"), F.max("_value").alias("high")
    )
    whole = whole.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in sorted(set(quantiles))])))
    rank = F.floor((F.col("n") - 1) * F.col("q") + 0.5)
    columns = (*key, "q", "rank", "n", "before", "low", "high", "distinct")
    spans = materialize(whole.withColumns({"rank": rank, "before": F.lit(0).cast("bigint")}).select(*columns), "spans")
    while not spans.filter(F.col("distinct") > ORDERED).isEmpty():
        narrowed = _closer(counts, spans.filter(F.col("distinct") > ORDERED), key)
        spans = materialize(spans.filter(F.col("distinct") <= ORDERED).unionByName(narrowed), "spans")
    inside = counts.join(broadcast_if_small(spans), key).filter(F.col("_value").between(F.col("low"), F.col("high")))
    upto = W.partitionBy(*key, "q").orderBy("_value").rowsBetween(W.unboundedPreceding, 0)
    reached = inside.withColumn("_upto", F.col("before") + F.sum("_n").over(upto)).filter(F.col("_upto") > F.col("rank"))
    return reached.groupBy(*key, "q").agg(F.min("_value").alias("value"), F.first("n").alias("n")).select(*by, "q", "value", "n")


def trim_bounds(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Per group: floor of the low quantile, and the high quantile."""
    found = nearest_quantiles(df, value, [TRIM_LOW, TRIM_HIGH], by)
    return found.groupBy(*by).agg(
        F.floor(F.max(F.when(F.col("q") == TRIM_LOW, F.col("value")))).cast("double").alias("low_bound"),
        F.max(F.when(F.col("q") == TRIM_HIGH, F.col("value"))).alias("high_bound"),
    )


def quantile_trim(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows between the trim bounds of their group, both ends included."""
    bounds = trim_bounds(df, value, by)
    if by:
        joined = df.join(broadcast_if_small(bounds), list(by))
        kept = joined.filter(F.col(value).between(F.col("low_bound"), F.col("high_bound")))
        return kept.drop("low_bound", "high_bound")
    both = bounds.select(F.struct("low_bound", "high_bound")).scalar()
    return df.filter(F.col(value).between(both["low_bound"], both["high_bound"]))


def describe_std(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.stddev_samp(value).alias("std"), F.count(value).alias("n"))


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", by: tuple[str, ...] = ()) -> DataFrame:
    """RMSE, R2 and MAE per group in one aggregation."""
    error = F.col(label) - F.col(prediction)
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.avg(error * error) / F.var_pop(label)).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
    )


def residual_histogram(df: DataFrame, residual: str = "residual", bins: int = RESIDUAL_BINS) -> DataFrame:
    """(bin, low, high, n) of equal-width bins from the minimum to the maximum."""
    low, high = df.agg(F.min(residual), F.max(residual)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin bigint, low double, high double, n bigint")
    width = (high - low) / bins
    position = F.floor((F.col(residual) - low) / width) if width else F.lit(0).cast("bigint")
    binned = df.filter(F.col(residual).isNotNull()).select(F.least(position, F.lit(bins - 1).cast("bigint")).alias("bin"))
    start = F.lit(low) + F.col("bin") * width
    return binned.groupBy("bin").agg(F.count("*").alias("n")).select(
        "bin", start.alias("low"), (start + width).alias("high"), "n"
    )


def residual_kde(df: DataFrame, residual: str = "residual", points: int = RESIDUAL_BINS, step: float = KDE_STEP) -> DataFrame:
    """(x, density): Gaussian kernel density at evenly spaced points, Scott bandwidth.

    Each residual is shared linearly between its two neighbours on a grid whose step is about ``step`` bandwidths; the grid's sums are
    then convolved with the kernel. Rows cost a constant each, whatever the number of points. Against the sums over rows, the
    density is off by at most ``step``² / 8 of the kernel's peak, 1 / (bandwidth · sqrt(2π)).
    """
    low, high, std, n = df.agg(F.min(residual), F.max(residual), F.stddev_samp(residual), F.count(residual)).first()
    if n < 2 or not std:
        return df.sparkSession.createDataFrame([], "x double, density double")
    bandwidth = std * n ** (-1 / 5)
    gap = (high - low) / math.ceil((high - low) / (bandwidth * step))
    place = (F.col(residual) - low) / gap
    left = F.floor(place)
    share = place - left
    ends = F.array(F.struct(left.alias("cell"), (1 - share).alias("w")), F.struct((left + 1).alias("cell"), share.alias("w")))
    grid = df.filter(F.col(residual).isNotNull()).select(F.inline(ends)).groupBy("cell").agg(F.sum("w").alias("w"))
    at = [low + (high - low) * i / (points - 1) for i in range(points)]
    scale = 1 / (n * bandwidth * math.sqrt(2 * math.pi))
    value = F.lit(low) + F.col("cell") * gap
    wide = grid.agg(
        *[(F.sum(F.col("w") * F.exp(-0.5 * F.pow((value - x) / bandwidth, 2))) * scale).alias(f"p{i}") for i, x in enumerate(at)]
    )
    return wide.select(F.inline(F.array(*[F.struct(F.lit(x).alias("x"), F.col(f"p{i}").alias("density")) for i, x in enumerate(at)])))


def best_score(scores: DataFrame, seq: str = "chunk_id") -> DataFrame:
    """The row with the lowest RMSE, the earliest of equals."""
    whole = F.struct(*scores.columns)
    return scores.agg(F.min_by(whole, F.struct("rmse", seq)).alias("best")).select("best.*")


def nonzero_improvement(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("percentage_improvement") != 0)


def frame_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns, column_names) in one row."""
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(",".join(df.columns)).alias("column_names")
    )
