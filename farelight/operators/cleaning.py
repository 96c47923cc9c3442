"""Ordered cleaning rules, their audit, imputation and data-quality reports."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelight.session import broadcast_if_small

# Charges that may be zero, in rule order after the fare; limits of the speed band.
ZERO_ALLOWED = ("tolls_amount", "extra", "mta_tax", "improvement_surcharge")
FIRST_YEAR = 1970
SPEED_LOW, SPEED_HIGH = 1, 200


def date_rule(column: str, as_of_year: int) -> Column:
    """Year after 1970 and not after ``as_of_year``, as a range the scan can be pruned by."""
    first = F.lit(datetime(FIRST_YEAR + 1, 1, 1)).cast("timestamp_ntz")
    end = F.lit(datetime(as_of_year + 1, 1, 1)).cast("timestamp_ntz")
    return (F.col(column) >= first) & (F.col(column) < end)


def charge_rule(column: str) -> Column:
    return F.col(column) >= 0 if column in ZERO_ALLOWED else F.col(column) > 0


def order_rule() -> Column:
    return F.col("tpep_pickup_datetime") < F.col("tpep_dropoff_datetime")


def speed_rule() -> Column:
    return (F.col("average_speed") > SPEED_LOW) & (F.col("average_speed") < SPEED_HIGH)


def ordered_rules(as_of_year: int) -> list[tuple[int, str, Column]]:
    """(number, name, predicate) in the order in which rows are rejected."""
    rules = [("pickup_year", date_rule("tpep_pickup_datetime", as_of_year))]
    rules.append(("dropoff_year", date_rule("tpep_dropoff_datetime", as_of_year)))
    for column in ("fare_amount", *ZERO_ALLOWED, "trip_distance"):
        rules.append((column, charge_rule(column)))
    rules.append(("pickup_before_dropoff", order_rule()))
    rules.append(("average_speed", speed_rule()))
    return [(number, name, rule) for number, (name, rule) in enumerate(rules, start=1)]


def abnormal_dates(df: DataFrame, columns: list[str], as_of_year: int) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [date_rule(c, as_of_year) for c in columns]))


def negative_charges(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [charge_rule(c) for c in columns]))


def nonpositive_duration(df: DataFrame) -> DataFrame:
    return df.filter(order_rule())


def speed_band(df: DataFrame) -> DataFrame:
    return df.filter(speed_rule())


def zero_distance_impute(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Replace distance 0 by the mean of the other distances of the same batch."""
    distance = F.col("trip_distance")
    means = df.groupBy(batch).agg(F.avg(F.when(distance != 0, distance)).alias("_mean_distance"))
    joined = df.join(broadcast_if_small(means), batch, "left")
    filled = F.when(distance == 0, F.col("_mean_distance")).otherwise(distance)
    return joined.withColumn("trip_distance", filled).drop("_mean_distance")


def first_failed_rule(as_of_year: int) -> Column:
    """Number of the first rule a row breaks, 0 when it keeps them all.

    A predicate that is null rejects the row, as a filter does.
    """
    failed = None
    for number, _, rule in ordered_rules(as_of_year):
        broken = ~F.coalesce(rule, F.lit(False))
        failed = F.when(broken, number) if failed is None else failed.when(broken, number)
    return failed.otherwise(0)


def apply_rules(df: DataFrame, as_of_year: int) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [rule for _, _, rule in ordered_rules(as_of_year)]))


def reject_audit(df: DataFrame, as_of_year: int, by: list[str] | None = None) -> DataFrame:
    """Rows per first failed rule, in one pass over the data."""
    keys = [F.col(c) for c in by or []]
    names = F.create_map(
        F.lit(0), F.lit("kept"), *[part for n, name, _ in ordered_rules(as_of_year) for part in (F.lit(n), F.lit(name))]
    )
    return (
        df.groupBy(*keys, first_failed_rule(as_of_year).alias("rule"))
        .agg(F.count("*").alias("n_rows"))
        .withColumn("rule_name", F.element_at(names, F.col("rule")))
    )


def null_report(df: DataFrame, only_nulls: bool = False) -> DataFrame:
    """(column_name, null_count) of all columns from one aggregation."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    report = counts.unpivot([], df.columns, "column_name", "null_count")
    return report.filter(F.col("null_count") > 0) if only_nulls else report


def type_counts(df: DataFrame) -> DataFrame:
    """Rows of both trip types in one row."""
    return df.agg(
        F.count_if(F.col("trip_type") == "short_trip").alias("n_short"),
        F.count_if(F.col("trip_type") == "long_trip").alias("n_long"),
    )


def assert_non_empty(df: DataFrame) -> DataFrame:
    """``type_counts`` that fails when evaluated unless both trip types have rows."""
    counts = type_counts(df)
    both = (F.col("n_short") > 0) & (F.col("n_long") > 0)
    return counts.withColumn("n_short", F.when(both, F.col("n_short")).otherwise(F.raise_error(F.lit("empty trip type")).cast("bigint")))


# Zone rows -------------------------------------------------------------------------------


def regex_keep(df: DataFrame, columns: list[str], pattern: str = r"^0\.\d+$") -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).rlike(pattern) for c in columns]))


def single_token_keep(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.size(F.split(F.col(c), " ")) == 1 for c in columns]))


def non_integer_keep(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) != F.floor(F.col(c)) for c in columns]))


def no_digit_keep(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [~F.col(c).rlike(r"\d") for c in columns]))
