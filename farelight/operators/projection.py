"""Typed projection and derived trip columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelight.functions import calendar, trip

# The text format of event times and the type of every raw column.
DATETIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
LANDING_TYPES = {
    "tpep_pickup_datetime": "datetime",
    "tpep_dropoff_datetime": "datetime",
    "pulocationid": "string",
    "dolocationid": "string",
    "trip_distance": "double",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
}

TIME_COLUMNS = {"pickup": "tpep_pickup_datetime", "dropoff": "tpep_dropoff_datetime"}


def typed_projection(df: DataFrame, types: dict[str, str] = LANDING_TYPES, strict: bool = True) -> DataFrame:
    """Cast the named columns. Strict mode fails on a bad value, lenient mode yields null."""
    casts = {}
    for name, kind in types.items():
        if kind == "datetime":
            pattern = F.lit(DATETIME_FORMAT)
            parsed = F.to_timestamp_ntz(F.col(name), pattern)
            if not strict:
                parsed = F.try_to_timestamp(F.col(name), pattern).cast("timestamp_ntz")
            casts[name] = parsed
        else:
            casts[name] = F.col(name).cast(kind) if strict else F.col(name).try_cast(kind)
    return df.withColumns(casts)


def quarantine(raw: DataFrame, types: dict[str, str] = LANDING_TYPES) -> DataFrame:
    """Raw rows with at least one value that does not parse."""
    parsed = {f"_{name}": F.col(name) for name in types}
    tried = typed_projection(raw.withColumns(parsed), types, strict=False)
    bad = F.lit(False)
    for name in types:
        bad = bad | (F.col(name).isNull() & F.col(f"_{name}").isNotNull())
    return tried.filter(bad).select(*[F.col(f"_{n}").alias(n) if n in types else F.col(n) for n in raw.columns])


def trip_duration(df: DataFrame, minimum: float = 1.0) -> DataFrame:
    """Minutes between pickup and dropoff; shorter trips than ``minimum`` are removed."""
    minutes = trip.duration_minutes(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    return df.withColumn("trip_duration", minutes).filter(F.col("trip_duration") >= minimum)


def time_features(df: DataFrame, holidays: list[date], ends: tuple[str, ...] = ("pickup", "dropoff")) -> DataFrame:
    """All calendar columns of both trip ends in one projection."""
    columns = {}
    for end in ends:
        ts = F.col(TIME_COLUMNS[end])
        columns[f"{end}_daytime"] = calendar.daytime(ts)
        columns[f"{end}_hour"] = calendar.hour(ts)
        columns[f"{end}_weekday"] = calendar.iso_weekday(ts)
        columns[f"{end}_weekday_str"] = calendar.weekday_name(calendar.iso_weekday(ts))
        columns[f"{end}_month"] = calendar.month(ts)
        columns[f"{end}_month_start"] = calendar.day_start(ts)
        columns[f"{end}_seconds"] = calendar.minutes_of_day(ts)
        columns[f"{end}_holiday"] = calendar.holiday_flag(ts, holidays)
        columns[f"{end}_weekend"] = calendar.weekend_flag(ts)
        columns[f"{end}_quarter"] = calendar.quarter_of_day(ts)
    return df.withColumns(columns)


def distance_km(df: DataFrame) -> DataFrame:
    return df.withColumn("trip_distance", trip.miles_to_km(F.col("trip_distance")))


def trip_cost(df: DataFrame, charges: tuple[str, ...] = trip.CHARGES) -> DataFrame:
    return df.withColumn("trip_cost", trip.trip_cost([F.col(c) for c in charges]))


def average_speed(df: DataFrame) -> DataFrame:
    return df.withColumn("average_speed", trip.average_speed(F.col("trip_distance"), F.col("trip_duration")))


def trip_keys(df: DataFrame, long_trip_km: float = trip.LONG_TRIP_KM) -> DataFrame:
    """Month, trip type and identity."""
    key = trip.hashing_key(
        F.col("tpep_pickup_datetime"), F.col("pulocationid"), F.col("dolocationid"), F.col("trip_cost")
    )
    return df.withColumns(
        {
            "partition_dt": calendar.month_key(F.col("tpep_pickup_datetime")),
            "trip_type": trip.trip_type(F.col("trip_distance"), long_trip_km),
            "hashing_key": key,
        }
    )


def one_hot_columns(df: DataFrame, column: str, max_levels: int = 1000) -> DataFrame:
    """One 0/1 column per distinct value, in value order; none is dropped.

    The levels become columns, so there may be at most ``max_levels``.
    """
    found = df.select(column).distinct().orderBy(column).limit(max_levels + 1).collect()
    if len(found) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} values")
    return df.withColumns(
        {
            f"{column}_{'null' if level is None else level}": F.col(column).eqNullSafe(F.lit(level)).cast("tinyint")
            for (level,) in found
        }
    ).drop(column)
