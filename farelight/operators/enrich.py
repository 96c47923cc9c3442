"""Zone joins, great-circle distance and suppression of known trips."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelight.functions import geo
from farelight.session import broadcast_if_small, materialize

KEY_COLUMNS = ("trip_type", "partition_dt", "hashing_key")


def zone_points(zones: DataFrame) -> DataFrame:
    """Per zone: what the joins add to a trip.

    Centroids are parsed here, once per zone and not once per trip.
    """
    coordinates = geo.point_coordinates(F.col("polygon_centroid"))
    return zones.select("objectid", "zone", "polygon_area", "polygon_centroid", coordinates.alias("coordinates")).withColumns(
        {
            "lat": geo.radians(F.element_at("coordinates", -1).cast("double")),
            "lng": geo.radians(F.element_at("coordinates", 1).cast("double")),
        }
    )


def column_rename(zones: DataFrame, prefix: str, names: tuple[str, ...] = ("zone", "polygon_area", "polygon_centroid")) -> DataFrame:
    return zones.withColumnsRenamed({name: f"{prefix}{name}" for name in names})


def _join_end(trips: DataFrame, points: DataFrame, prefix: str, end: str, location: str) -> DataFrame:
    side = column_rename(points, prefix).withColumnsRenamed(
        {"coordinates": f"{end}_coordinates", "lat": f"_{prefix}lat", "lng": f"_{prefix}lng", "objectid": location}
    )
    return trips.join(side, location, "left")


def enrich_pickup_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    side = column_rename(zones.select("objectid", "zone", "polygon_area", "polygon_centroid"), "pu_")
    return trips.join(broadcast_if_small(side.withColumnRenamed("objectid", "pulocationid")), "pulocationid", "left")


def enrich_dropoff_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    side = column_rename(zones.select("objectid", "zone", "polygon_area", "polygon_centroid"), "do_")
    return trips.join(broadcast_if_small(side.withColumnRenamed("objectid", "dolocationid")), "dolocationid", "left")


def drop_null_zone(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("pu_zone").isNotNull() & F.col("do_zone").isNotNull())


def enrich_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Both zone joins, removal of trips without zones, and the centroid distance.

    The removal turns both outer joins into inner ones, so it runs inside the joins.
    """
    points = broadcast_if_small(zone_points(zones))
    both = _join_end(trips, points, "pu_", "pickup", "pulocationid")
    both = drop_null_zone(_join_end(both, points, "do_", "dropoff", "dolocationid"))
    distance = geo.haversine_from_radians(F.col("_pu_lat"), F.col("_pu_lng"), F.col("_do_lat"), F.col("_do_lng"))
    return both.withColumn("haversine_centroid_distance", distance).drop("_pu_lat", "_pu_lng", "_do_lat", "_do_lng")


def on_days(trips: DataFrame, days: list[date], ts: str = "tpep_pickup_datetime") -> DataFrame:
    """Trips that start on one of ``days``; the list is turned into one literal, no side is sent along."""
    return trips.filter(F.to_date(ts).isin(days)) if days else trips.limit(0)


def distinct_keys(df: DataFrame, keys: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    return df.select(*keys).distinct()


def new_keys_anti(new: DataFrame, existing: DataFrame, keys: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    """Distinct keys of ``new`` that ``existing`` does not have."""
    return distinct_keys(new, keys).join(distinct_keys(existing, keys), list(keys), "left_anti")


def semi_by_key(df: DataFrame, wanted: DataFrame, keys: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    return df.join(materialize(distinct_keys(wanted, keys), "keys"), list(keys), "left_semi")


def unseen_trips(new: DataFrame, existing: DataFrame, keys: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    """Trips whose key is not stored yet; repeated trips inside ``new`` are kept.

    One anti join against the pre-aggregated keys does what a key difference followed by
    a membership filter would. Copies of one trip may be many: as the distinct keys are
    stored first, both join sides are plain shuffles, and adaptive execution splits the
    trips of a skewed partition over tasks.
    """
    return new.join(materialize(distinct_keys(existing, keys), "keys"), list(keys), "left_anti")


def stored_keys(table: DataFrame, trips: DataFrame, keys: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    """Keys of the stored months that ``trips`` has rows of.

    Keys are compared within a month; the months reach the scan as a dynamic partition filter, so the other
    directories are not read.
    """
    months = broadcast_if_small(trips.select("partition_dt").distinct())
    return table.join(months, "partition_dt", "left_semi").select(*keys)


def drop_repeats(df: DataFrame, keys: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    """One trip per key (optional: by default repeats inside a batch stay)."""
    return df.dropDuplicates(list(keys))


def incremental_enrich(
    new: DataFrame,
    existing: DataFrame | None,
    zones: DataFrame,
    keys: tuple[str, ...] = KEY_COLUMNS,
    dedupe_batch: bool = False,
) -> DataFrame:
    """Enriched rows to append: all of them for an empty target, else the unseen ones."""
    rows = new if existing is None else unseen_trips(new, existing, keys)
    if dedupe_batch:
        rows = drop_repeats(rows, keys)
    return enrich_trips(rows, zones)


def indexed_enrich(new: DataFrame, index, zones: DataFrame, number: int, dedupe_batch: bool = False) -> DataFrame:
    """Enriched rows to append, as ``incremental_enrich``, for a target whose keys are in a ``KeyIndex``.

    The unseen keys are stored in the index as those of run ``number``. Stored keys are read where they lie. Trips are only
    joined if some of their keys were stored before, and then with these keys alone; copies of one trip may be many, which
    adaptive execution splits. They are joined before zones are added, as that shuffle moves all their columns.
    """
    enriched = enrich_trips(new, zones)
    keys, unseen = index.append_unseen(enriched, number, new)
    if not unseen:
        return enriched.limit(0)
    if unseen < keys:
        enriched = enrich_trips(new.join(broadcast_if_small(index.seen(enriched, number, new)), list(index.keys), "left_anti"), zones)
    return drop_repeats(enriched, index.keys) if dedupe_batch else enriched
