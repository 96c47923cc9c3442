"""Queries: zone joins and key suppression."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelight.catalog import views
from farelight.catalog.registry import query
from farelight.operators import enrich
from farelight.session import work_path
from farelight.sources.key_index import KeyIndex


@query(
    "enrich_pickup_zone",
    "SELECT trip_key, zone AS pu_zone, round(polygon_area, 10) AS pu_polygon_area FROM trips LEFT JOIN zones ON pulocationid = objectid",
    ("trips", "zones"),
)
def enrich_pickup_zone(spark, sf_dir):
    rows = enrich.enrich_pickup_zone(views.trips(spark, sf_dir), views.zone_dimension(spark))
    return rows.select("trip_key", "pu_zone", F.round("pu_polygon_area", 10).alias("pu_polygon_area"))


@query(
    "enrich_dropoff_zone",
    "SELECT trip_key, zone AS do_zone, round(polygon_area, 10) AS do_polygon_area FROM trips LEFT JOIN zones ON dolocationid = objectid",
    ("trips", "zones"),
)
def enrich_dropoff_zone(spark, sf_dir):
    rows = enrich.enrich_dropoff_zone(views.trips(spark, sf_dir), views.zone_dimension(spark))
    return rows.select("trip_key", "do_zone", F.round("do_polygon_area", 10).alias("do_polygon_area"))


KEYED = ("trip_type", "partition_dt", "hashing_key")


@query(
    "new_keys_anti",
    "SELECT DISTINCT trip_type, partition_dt, hashing_key FROM clean WHERE (trip_type, partition_dt, hashing_key) NOT IN "
    "(SELECT (trip_type, partition_dt, hashing_key) FROM clean WHERE batch_id < 5)",
    ("clean",),
)
def new_keys_anti(spark, sf_dir):
    rows = views.clean(spark, sf_dir)
    return enrich.new_keys_anti(rows, rows.filter(F.col("batch_id") < 5))


@query(
    "semi_by_key",
    "SELECT trip_key FROM clean WHERE (trip_type, partition_dt, hashing_key) IN "
    "(SELECT (trip_type, partition_dt, hashing_key) FROM clean WHERE batch_id = 5)",
    ("clean",),
)
def semi_by_key(spark, sf_dir):
    rows = views.clean(spark, sf_dir)
    wanted = enrich.distinct_keys(rows.filter(F.col("batch_id") == 5))
    return enrich.semi_by_key(rows, wanted).select("trip_key")


@query("distinct_keys", "SELECT DISTINCT trip_type, partition_dt, hashing_key FROM clean", ("clean",))
def distinct_keys(spark, sf_dir):
    return enrich.distinct_keys(views.clean(spark, sf_dir))


@query(
    "holiday_membership",
    "SELECT trip_key FROM trips WHERE tpep_pickup_datetime::DATE IN (SELECT d FROM holidays)",
    ("trips", "holidays"),
)
def holiday_membership(spark, sf_dir):
    return enrich.on_days(views.trips(spark, sf_dir), views.HOLIDAYS).select("trip_key")


ENRICHED_COLUMNS = (
    "trip_key, trip_type, partition_dt, hashing_key, pu_zone, do_zone, round(pu_polygon_area, 10) AS pu_polygon_area, "
    "round(do_polygon_area, 10) AS do_polygon_area, round(trip_distance, 6) AS trip_distance, trip_duration, "
    "round(haversine_centroid_distance, 6) AS haversine_centroid_distance"
)


def _shown(rows):
    return rows.select(
        "trip_key", "trip_type", "partition_dt", "hashing_key", "pu_zone", "do_zone",
        F.round("pu_polygon_area", 10).alias("pu_polygon_area"),
        F.round("do_polygon_area", 10).alias("do_polygon_area"),
        F.round("trip_distance", 6).alias("trip_distance"),
        "trip_duration",
        F.round("haversine_centroid_distance", 6).alias("haversine_centroid_distance"),
    )


@query("enrich_trips", f"SELECT {ENRICHED_COLUMNS} FROM enriched", ("enriched",))
def enrich_trips(spark, sf_dir):
    return _shown(views.enriched(spark, sf_dir))


@query(
    "incremental_enrich",
    f"SELECT {ENRICHED_COLUMNS} FROM enriched WHERE (trip_type, partition_dt, hashing_key) NOT IN "
    "(SELECT (trip_type, partition_dt, hashing_key) FROM enriched WHERE batch_id < 4)",
    ("enriched",),
)
def incremental_enrich(spark, sf_dir):
    rows = views.clean(spark, sf_dir)
    dimension = views.zone_dimension(spark)
    stored = enrich.enrich_trips(rows.filter(F.col("batch_id") < 4), dimension)
    return _shown(enrich.incremental_enrich(rows, stored, dimension))


@query(
    "indexed_enrich",
    f"SELECT {ENRICHED_COLUMNS} FROM enriched WHERE (trip_type, partition_dt, hashing_key) NOT IN "
    "(SELECT (trip_type, partition_dt, hashing_key) FROM enriched WHERE batch_id < 4)",
    ("enriched",),
)
def indexed_enrich(spark, sf_dir):
    """Half of the trips, then all of them: the second run meets the keys the first one left in the index."""
    rows = views.clean(spark, sf_dir)
    dimension = views.zone_dimension(spark)
    index = KeyIndex(spark, work_path(spark, "keys"), buckets=8)
    index.append_unseen(enrich.enrich_trips(rows.filter(F.col("batch_id") < 4), dimension), 1)
    return _shown(enrich.indexed_enrich(rows, index, dimension, 2))


@query(
    "incremental_enrich_dedupe",
    "SELECT trip_type, partition_dt, count(DISTINCT hashing_key) AS n_rows FROM enriched "
    "WHERE (trip_type, partition_dt, hashing_key) NOT IN "
    "(SELECT (trip_type, partition_dt, hashing_key) FROM enriched WHERE batch_id < 4) GROUP BY ALL",
    ("enriched",),
)
def incremental_enrich_dedupe(spark, sf_dir):
    rows = views.clean(spark, sf_dir)
    dimension = views.zone_dimension(spark)
    stored = enrich.enrich_trips(rows.filter(F.col("batch_id") < 4), dimension)
    fresh = enrich.incremental_enrich(rows, stored, dimension, dedupe_batch=True)
    return fresh.groupBy("trip_type", "partition_dt").agg(F.count("*").alias("n_rows"))
