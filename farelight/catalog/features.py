"""Queries: derived trip columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelight.catalog import views
from farelight.catalog.registry import query
from farelight.functions import calendar, trip
from farelight.operators import cleaning, enrich, incremental, projection, requests, zones


def pickup():
    return F.col("tpep_pickup_datetime")


def dropoff():
    return F.col("tpep_dropoff_datetime")


@query(
    "typed_projection",
    "SELECT trip_key, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, pulocationid, dolocationid, "
    "fare_amount, extra, mta_tax, tolls_amount, improvement_surcharge FROM trips",
    ("trips",),
)
def typed_projection(spark, sf_dir):
    return projection.typed_projection(views.raw_trips(spark, sf_dir)).drop("batch_id")


@query(
    "typed_projection_lenient",
    "SELECT trip_key, CASE WHEN batch_id = 3 THEN NULL ELSE tpep_pickup_datetime END AS tpep_pickup_datetime, "
    "CASE WHEN batch_id = 5 THEN NULL ELSE fare_amount END AS fare_amount FROM trips",
    ("trips",),
)
def typed_projection_lenient(spark, sf_dir):
    raw = views.raw_trips(spark, sf_dir)
    spoiled = raw.withColumns(
        {
            "tpep_pickup_datetime": F.when(F.col("batch_id") == 3, "soon").otherwise(pickup()),
            "fare_amount": F.when(F.col("batch_id") == 5, "n/a").otherwise(F.col("fare_amount")),
        }
    )
    typed = projection.typed_projection(spoiled, strict=False)
    return typed.select("trip_key", "tpep_pickup_datetime", "fare_amount")


@query("trip_duration", "SELECT trip_key, trip_duration FROM timed", ("timed",))
def trip_duration(spark, sf_dir):
    return views.timed(spark, sf_dir).select("trip_key", "trip_duration")


@query(
    "trip_hour",
    "SELECT trip_key, hour(tpep_pickup_datetime)::TINYINT AS pickup_hour, hour(tpep_dropoff_datetime)::TINYINT AS dropoff_hour FROM trips",
    ("trips",),
)
def trip_hour(spark, sf_dir):
    rows = views.trips(spark, sf_dir)
    return rows.select("trip_key", calendar.hour(pickup()).alias("pickup_hour"), calendar.hour(dropoff()).alias("dropoff_hour"))


@query(
    "trip_month",
    "SELECT trip_key, month(tpep_pickup_datetime)::TINYINT AS pickup_month, month(tpep_dropoff_datetime)::TINYINT AS dropoff_month FROM trips",
    ("trips",),
)
def trip_month(spark, sf_dir):
    rows = views.trips(spark, sf_dir)
    return rows.select("trip_key", calendar.month(pickup()).alias("pickup_month"), calendar.month(dropoff()).alias("dropoff_month"))


@query(
    "trip_weekday",
    "SELECT trip_key, isodow(tpep_pickup_datetime)::TINYINT AS pickup_weekday, dayname(tpep_pickup_datetime) AS pickup_weekday_str, "
    "isodow(tpep_dropoff_datetime)::TINYINT AS dropoff_weekday, dayname(tpep_dropoff_datetime) AS dropoff_weekday_str FROM trips",
    ("trips",),
)
def trip_weekday(spark, sf_dir):
    rows = views.trips(spark, sf_dir)
    named = []
    for end, ts in (("pickup", pickup()), ("dropoff", dropoff())):
        number = calendar.iso_weekday(ts)
        named += [number.alias(f"{end}_weekday"), calendar.weekday_name(number).alias(f"{end}_weekday_str")]
    return rows.select("trip_key", *named)


@query(
    "trip_daytime",
    "SELECT trip_key, (CASE WHEN p BETWEEN 7 AND 10 OR p BETWEEN 16 AND 19 THEN 1 WHEN p >= 20 OR p <= 6 THEN 2 ELSE 3 END)::BIGINT AS pickup_daytime, "
    "(CASE WHEN d BETWEEN 7 AND 10 OR d BETWEEN 16 AND 19 THEN 1 WHEN d >= 20 OR d <= 6 THEN 2 ELSE 3 END)::BIGINT AS dropoff_daytime "
    "FROM (SELECT trip_key, hour(tpep_pickup_datetime) AS p, hour(tpep_dropoff_datetime) AS d FROM trips)",
    ("trips",),
)
def trip_daytime(spark, sf_dir):
    rows = views.trips(spark, sf_dir)
    return rows.select(
        "trip_key", calendar.daytime(pickup()).alias("pickup_daytime"), calendar.daytime(dropoff()).alias("dropoff_daytime")
    )


@query("miles_to_km", "SELECT trip_key, round(trip_distance * 1.60934::DOUBLE, 2) AS trip_distance FROM trips", ("trips",))
def miles_to_km(spark, sf_dir):
    return projection.distance_km(views.trips(spark, sf_dir)).select("trip_key", "trip_distance")


@query(
    "zero_distance_impute",
    "SELECT trip_key, batch_id, round(trip_distance, 6) AS trip_distance FROM imputed",
    ("imputed",),
)
def zero_distance_impute(spark, sf_dir):
    rows = cleaning.zero_distance_impute(views.kms(spark, sf_dir))
    return rows.select("trip_key", "batch_id", F.round("trip_distance", 6).alias("trip_distance"))


@query(
    "trip_cost",
    "SELECT trip_key, fare_amount + extra + mta_tax + tolls_amount + improvement_surcharge AS trip_cost FROM trips",
    ("trips",),
)
def trip_cost(spark, sf_dir):
    return projection.trip_cost(views.trips(spark, sf_dir)).select("trip_key", "trip_cost")


@query(
    "minutes_of_day",
    "SELECT trip_key, date_trunc('day', tpep_pickup_datetime)::TIMESTAMP AS pickup_month_start, "
    "date_diff('minute', date_trunc('day', tpep_pickup_datetime)::TIMESTAMP, tpep_pickup_datetime) AS pickup_seconds, "
    "date_diff('minute', date_trunc('day', tpep_dropoff_datetime)::TIMESTAMP, tpep_dropoff_datetime) AS dropoff_seconds FROM trips",
    ("trips",),
)
def minutes_of_day(spark, sf_dir):
    return views.trips(spark, sf_dir).select(
        "trip_key",
        calendar.day_start(pickup()).alias("pickup_month_start"),
        calendar.minutes_of_day(pickup()).alias("pickup_seconds"),
        calendar.minutes_of_day(dropoff()).alias("dropoff_seconds"),
    )


@query(
    "quarter_of_day",
    "SELECT trip_key, ((hour(tpep_pickup_datetime) * 60 + minute(tpep_pickup_datetime)) // 15)::TINYINT AS pickup_quarter, "
    "((hour(tpep_dropoff_datetime) * 60 + minute(tpep_dropoff_datetime)) // 15)::TINYINT AS dropoff_quarter FROM trips",
    ("trips",),
)
def quarter_of_day(spark, sf_dir):
    return views.trips(spark, sf_dir).select(
        "trip_key",
        calendar.quarter_of_day(pickup()).alias("pickup_quarter"),
        calendar.quarter_of_day(dropoff()).alias("dropoff_quarter"),
    )


@query(
    "quarter_label",
    "SELECT trip_key, strftime(time_bucket(INTERVAL 15 MINUTE, tpep_pickup_datetime), '%H:%M') AS pickup_quarter FROM trips",
    ("trips",),
)
def quarter_label(spark, sf_dir):
    return views.trips(spark, sf_dir).select("trip_key", calendar.quarter_label(pickup()).alias("pickup_quarter"))


@query(
    "holiday_flag",
    "SELECT trip_key, (tpep_pickup_datetime::DATE IN (SELECT d FROM holidays))::TINYINT AS pickup_holiday, "
    "(tpep_dropoff_datetime::DATE IN (SELECT d FROM holidays))::TINYINT AS dropoff_holiday FROM trips",
    ("trips", "holidays"),
)
def holiday_flag(spark, sf_dir):
    return views.trips(spark, sf_dir).select(
        "trip_key",
        calendar.holiday_flag(pickup(), views.HOLIDAYS).alias("pickup_holiday"),
        calendar.holiday_flag(dropoff(), views.HOLIDAYS).alias("dropoff_holiday"),
    )


@query(
    "weekend_flag",
    "SELECT trip_key, (isodow(tpep_pickup_datetime) IN (6, 7))::TINYINT AS pickup_weekend, "
    "(isodow(tpep_dropoff_datetime) IN (6, 7))::TINYINT AS dropoff_weekend FROM trips",
    ("trips",),
)
def weekend_flag(spark, sf_dir):
    return views.trips(spark, sf_dir).select(
        "trip_key",
        calendar.weekend_flag(pickup()).alias("pickup_weekend"),
        calendar.weekend_flag(dropoff()).alias("dropoff_weekend"),
    )


@query(
    "average_speed",
    "SELECT trip_key, trip_distance / (trip_duration / 60)::FLOAT AS average_speed FROM kms",
    ("kms",),
)
def average_speed(spark, sf_dir):
    return projection.average_speed(views.kms(spark, sf_dir)).select("trip_key", "average_speed")


@query("month_partition_key", "SELECT trip_key, strftime(tpep_pickup_datetime, '%Y%m') AS partition_dt FROM trips", ("trips",))
def month_partition_key(spark, sf_dir):
    return views.trips(spark, sf_dir).select("trip_key", calendar.month_key(pickup()).alias("partition_dt"))


@query(
    "trip_type",
    "SELECT trip_key, CASE WHEN trip_distance > 35.0 THEN 'long_trip' ELSE 'short_trip' END AS trip_type FROM kms",
    ("kms",),
)
def trip_type(spark, sf_dir):
    return views.kms(spark, sf_dir).select("trip_key", trip.trip_type(F.col("trip_distance")).alias("trip_type"))


@query(
    "hashing_key",
    "SELECT trip_key, md5(concat_ws('|', epoch_us(tpep_pickup_datetime), pulocationid, dolocationid, "
    "round((fare_amount + extra + mta_tax + tolls_amount + improvement_surcharge) * 10000)::BIGINT)) AS hashing_key FROM trips",
    ("trips",),
)
def hashing_key(spark, sf_dir):
    rows = projection.trip_cost(views.trips(spark, sf_dir))
    key = trip.hashing_key(pickup(), F.col("pulocationid"), F.col("dolocationid"), F.col("trip_cost"))
    return rows.select("trip_key", key.alias("hashing_key"))


@query(
    "hashing_key_64",
    # Trips that share a key, by the first trip of each.
    "SELECT min(trip_key) AS first_trip, count(*) AS n FROM trips GROUP BY tpep_pickup_datetime, pulocationid, dolocationid, "
    "round((fare_amount + extra + mta_tax + tolls_amount + improvement_surcharge) * 10000)",
    ("trips",),
)
def hashing_key_64(spark, sf_dir):
    rows = projection.trip_cost(views.trips(spark, sf_dir))
    key = trip.short_hashing_key(pickup(), F.col("pulocationid"), F.col("dolocationid"), F.col("trip_cost"))
    return rows.groupBy(key.alias("k")).agg(F.min("trip_key").alias("first_trip"), F.count("*").alias("n")).drop("k")


@query(
    "column_rename",
    "SELECT p_partkey::VARCHAR AS objectid, p_name AS pu_zone, p_retailprice AS pu_polygon_area, p_type AS pu_polygon_centroid FROM part",
)
def column_rename(spark, sf_dir):
    rows = views.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("objectid"),
        F.col("p_name").alias("zone"),
        F.col("p_retailprice").alias("polygon_area"),
        F.col("p_type").alias("polygon_centroid"),
    )
    return enrich.column_rename(rows, "pu_")


@query(
    "one_hot_columns",
    "SELECT trip_key, (d = 1)::TINYINT AS pickup_daytime_1, (d = 2)::TINYINT AS pickup_daytime_2, (d = 3)::TINYINT AS pickup_daytime_3 "
    "FROM (SELECT trip_key, CASE WHEN h BETWEEN 7 AND 10 OR h BETWEEN 16 AND 19 THEN 1 WHEN h >= 20 OR h <= 6 THEN 2 ELSE 3 END AS d "
    "FROM (SELECT trip_key, hour(tpep_pickup_datetime) AS h FROM trips))",
    ("trips",),
)
def one_hot_columns(spark, sf_dir):
    rows = views.trips(spark, sf_dir).select("trip_key", calendar.daytime(pickup()).alias("pickup_daytime"))
    return projection.one_hot_columns(rows, "pickup_daytime")


@query(
    "struct_unnest",
    "SELECT i, 'MultiPolygon' AS type, (1 + has_second::INTEGER)::INTEGER AS n_polygons FROM parcels",
    ("parcels",),
)
def struct_unnest(spark, sf_dir):
    rows = zones.struct_unnest(views.parcels(spark, sf_dir))
    return rows.select("i", "type", F.size("coordinates").alias("n_polygons"))


@query(
    "request_features",
    "SELECT trip_key, hour(t)::TINYINT AS pickup_hour, isodow(t)::TINYINT AS pickup_weekday, "
    "((hour(t) * 60 + minute(t)) // 15)::TINYINT AS pickup_quarter, (hour(t) * 60 + minute(t))::BIGINT AS pickup_seconds, "
    "(t::DATE IN (SELECT d FROM holidays))::TINYINT AS pickup_holiday, (isodow(t) >= 6)::TINYINT AS pickup_weekend, "
    "((hour(t) * 60 + minute(t)) // 15 + 1)::TINYINT AS advisor_quarter, "
    "((day(t) - 1) * 1440 + hour(t) * 60 + minute(t))::BIGINT AS advisor_seconds "
    "FROM (SELECT trip_key, tpep_pickup_datetime AS t FROM trips)",
    ("trips", "holidays"),
)
def request_features(spark, sf_dir):
    rows = views.trips(spark, sf_dir).select("trip_key", pickup())
    rows = requests.end_features(rows, "pickup", pickup(), views.HOLIDAYS).drop("pickup_daytime")
    advisor = requests.end_features(rows, "advisor", pickup(), [], quarter_base=1, since_month=True)
    kept = [c for c in rows.columns if c != "tpep_pickup_datetime"]
    return advisor.select(*kept, "advisor_quarter", "advisor_seconds")


@query(
    "date_arithmetic",
    "SELECT o_orderkey, (o_orderdate::DATE - (o_orderkey % 400)::INTEGER)::DATE AS start_day FROM orders",
)
def date_arithmetic(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders")
    start = incremental.days_before(F.to_date("o_orderdate"), (F.col("o_orderkey") % 400).cast("int"))
    return rows.select("o_orderkey", start.alias("start_day"))
