"""Per-trip measures and keys, as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelight.functions.calendar import micros

# Unit factor, trip type limit and the charges that make up the cost.
KM_PER_MILE = 1.60934
LONG_TRIP_KM = 35.0
CHARGES = ("fare_amount", "extra", "mta_tax", "tolls_amount", "improvement_surcharge")


def hundredths(value: Column) -> Column:
    """Round to two places, half up, in double arithmetic (no decimal detour per row)."""
    return F.floor(value * 100 + 0.5) / 100


def duration_minutes(pickup: Column, dropoff: Column) -> Column:
    return hundredths((micros(dropoff) - micros(pickup)) / 6e7)


def miles_to_km(miles: Column) -> Column:
    return hundredths(miles * KM_PER_MILE)


def trip_cost(charges: list[Column]) -> Column:
    """Sum of the charges; null when one of them is null."""
    return reduce(add, charges)


def average_speed(km: Column, minutes: Column) -> Column:
    """km/h; the hours are single precision, as stored results were computed that way."""
    return km / (minutes / 60).cast("float")


def trip_type(km: Column, limit: float = LONG_TRIP_KM) -> Column:
    return F.when(km > limit, "long_trip").otherwise("short_trip")


def _key_parts(pickup: Column, pu_id: Column, do_id: Column, cost: Column) -> list[Column]:
    return [micros(pickup), pu_id, do_id, F.round(cost * 10000).cast("bigint")]


def hashing_key(pickup: Column, pu_id: Column, do_id: Column, cost: Column) -> Column:
    """128-bit identity of a trip.

    64 bits would already collide by the thousands at 10^12 rows, and a collision here
    drops a trip. Rows with a null part share one key, as a null concatenation does.
    """
    parts = [c.cast("string") for c in _key_parts(pickup, pu_id, do_id, cost)]
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in parts])
    return F.md5(F.when(complete, F.concat_ws("|", *parts)).otherwise("").cast("binary"))


def short_hashing_key(pickup: Column, pu_id: Column, do_id: Column, cost: Column) -> Column:
    """64-bit variant for tables small enough to accept its collision rate."""
    parts = _key_parts(pickup, pu_id, do_id, cost)
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in parts])
    return F.when(complete, F.xxhash64(*parts)).otherwise(F.xxhash64(F.lit("")))
