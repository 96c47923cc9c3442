"""Queries: rules, audits and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelight.catalog import views
from farelight.catalog.registry import AS_OF, query
from farelight.operators import cleaning, enrich, incremental, requests, sequence, stats

YEAR = AS_OF.year


@query(
    "abnormal_dates",
    "SELECT trip_key FROM trips WHERE year(tpep_pickup_datetime) > 1970 AND year(tpep_pickup_datetime) <= 2026 "
    "AND year(tpep_dropoff_datetime) > 1970 AND year(tpep_dropoff_datetime) <= 2026",
    ("trips",),
)
def abnormal_dates(spark, sf_dir):
    rows = views.trips(spark, sf_dir)
    return cleaning.abnormal_dates(rows, ["tpep_pickup_datetime", "tpep_dropoff_datetime"], YEAR).select("trip_key")


@query(
    "negative_charges",
    "SELECT trip_key FROM trips WHERE fare_amount > 0 AND tolls_amount >= 0 AND extra >= 0 AND mta_tax >= 0 "
    "AND improvement_surcharge >= 0 AND trip_distance > 0",
    ("trips",),
)
def negative_charges(spark, sf_dir):
    columns = ["fare_amount", "tolls_amount", "extra", "mta_tax", "improvement_surcharge", "trip_distance"]
    return cleaning.negative_charges(views.trips(spark, sf_dir), columns).select("trip_key")


@query("nonpositive_duration", "SELECT trip_key FROM trips WHERE tpep_pickup_datetime < tpep_dropoff_datetime", ("trips",))
def nonpositive_duration(spark, sf_dir):
    return cleaning.nonpositive_duration(views.trips(spark, sf_dir)).select("trip_key")


@query("min_duration", "SELECT trip_key, trip_duration FROM timed", ("timed",))
def min_duration(spark, sf_dir):
    return views.timed(spark, sf_dir).select("trip_key", "trip_duration")


@query("speed_band", "SELECT trip_key FROM measured WHERE average_speed > 1 AND average_speed < 200", ("measured",))
def speed_band(spark, sf_dir):
    return cleaning.speed_band(views.measured(spark, sf_dir)).select("trip_key")


@query(
    "reject_audit",
    "SELECT batch_id, rule, count(*) AS n_rows FROM ruled GROUP BY batch_id, rule",
    ("ruled",),
)
def reject_audit(spark, sf_dir):
    return cleaning.reject_audit(views.measured(spark, sf_dir), YEAR, ["batch_id"]).drop("rule_name")


def _with_nulls(spark, sf_dir):
    rows = views.trips(spark, sf_dir)
    return rows.select(
        F.when(F.col("batch_id") != 2, F.col("fare_amount")).alias("fare_amount"),
        F.when(F.col("trip_distance") != 0, F.col("trip_distance")).alias("trip_distance"),
        "tolls_amount",
    )


NULLED = (
    "(SELECT CASE WHEN batch_id <> 2 THEN fare_amount END AS fare_amount, "
    "CASE WHEN trip_distance <> 0 THEN trip_distance END AS trip_distance, tolls_amount FROM trips)"
)


@query(
    "null_report",
    f"SELECT column_name, null_count FROM (SELECT count(*) - count(fare_amount) AS fare_amount, "
    f"count(*) - count(trip_distance) AS trip_distance, count(*) - count(tolls_amount) AS tolls_amount FROM {NULLED}) "
    "UNPIVOT (null_count FOR column_name IN (fare_amount, trip_distance, tolls_amount)) WHERE null_count > 0",
    ("trips",),
)
def null_report(spark, sf_dir):
    return cleaning.null_report(_with_nulls(spark, sf_dir), only_nulls=True)


@query(
    "null_counts",
    f"SELECT column_name, null_count FROM (SELECT count(*) - count(fare_amount) AS fare_amount, "
    f"count(*) - count(trip_distance) AS trip_distance, count(*) - count(tolls_amount) AS tolls_amount FROM {NULLED}) "
    "UNPIVOT (null_count FOR column_name IN (fare_amount, trip_distance, tolls_amount))",
    ("trips",),
)
def null_counts(spark, sf_dir):
    return cleaning.null_report(_with_nulls(spark, sf_dir))


@query(
    "non_empty_assert",
    "SELECT count(*) FILTER (trip_type = 'short_trip') AS n_short, count(*) FILTER (trip_type = 'long_trip') AS n_long FROM clean",
    ("clean",),
)
def non_empty_assert(spark, sf_dir):
    return cleaning.assert_non_empty(views.clean(spark, sf_dir))


@query(
    "regex_keep",
    r"SELECT i FROM raw_zones WHERE regexp_matches(shape_leng, '^0\.\d+$') AND regexp_matches(shape_area, '^0\.\d+$')",
    ("raw_zones",),
)
def regex_keep(spark, sf_dir):
    return cleaning.regex_keep(views.raw_zones(spark, sf_dir), ["shape_leng", "shape_area"]).select("i")


@query(
    "single_token_keep",
    "SELECT i FROM raw_zones WHERE len(string_split(shape_leng, ' ')) = 1 AND len(string_split(shape_area, ' ')) = 1 "
    "AND len(string_split(objectid, ' ')) = 1 AND len(string_split(location_id, ' ')) = 1",
    ("raw_zones",),
)
def single_token_keep(spark, sf_dir):
    columns = ["shape_leng", "shape_area", "objectid", "location_id"]
    return cleaning.single_token_keep(views.raw_zones(spark, sf_dir), columns).select("i")


@query(
    "non_integer_keep",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_extendedprice <> floor(l_extendedprice) "
    "AND l_discount <> floor(l_discount)",
)
def non_integer_keep(spark, sf_dir):
    rows = cleaning.non_integer_keep(views.table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_discount"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "no_digit_keep",
    r"SELECT i FROM raw_zones WHERE NOT regexp_matches(zone, '\d') AND NOT regexp_matches(borough, '\d')",
    ("raw_zones",),
)
def no_digit_keep(spark, sf_dir):
    return cleaning.no_digit_keep(views.raw_zones(spark, sf_dir), ["zone", "borough"]).select("i")


@query(
    "drop_null_zone",
    "SELECT trip_key FROM clean WHERE pulocationid::INTEGER <= 263 AND dolocationid::INTEGER <= 263",
    ("clean",),
)
def drop_null_zone(spark, sf_dir):
    dimension = views.zone_dimension(spark)
    both = enrich.enrich_dropoff_zone(enrich.enrich_pickup_zone(views.clean(spark, sf_dir), dimension), dimension)
    return enrich.drop_null_zone(both).select("trip_key")


@query(
    "quantile_trim",
    "SELECT trip_key, t.chunk_id, trip_duration FROM (SELECT *, l_orderkey // 1000 AS chunk_id FROM timed) t JOIN ("
    "SELECT chunk_id, floor(max(trip_duration) FILTER (rn = floor((n - 1) * 0.05::DOUBLE + 0.5))) AS lo, "
    "max(trip_duration) FILTER (rn = floor((n - 1) * 0.99::DOUBLE + 0.5)) AS hi FROM (SELECT l_orderkey // 1000 AS chunk_id, trip_duration, "
    "row_number() OVER (PARTITION BY l_orderkey // 1000 ORDER BY trip_duration) - 1 AS rn, "
    "count(*) OVER (PARTITION BY l_orderkey // 1000) AS n FROM timed) GROUP BY chunk_id) b "
    "ON t.chunk_id = b.chunk_id WHERE trip_duration BETWEEN lo AND hi",
    ("timed",),
)
def quantile_trim(spark, sf_dir):
    rows = views.timed(spark, sf_dir).withColumn("chunk_id", F.floor(F.col("l_orderkey") / 1000))
    return stats.quantile_trim(rows, "trip_duration", ("chunk_id",)).select("trip_key", "chunk_id", "trip_duration")


@query(
    "in_list_filter",
    "SELECT trip_key FROM clean WHERE hashing_key NOT IN (SELECT hashing_key FROM clean WHERE batch_id < 6)",
    ("clean",),
)
def in_list_filter(spark, sf_dir):
    rows = views.clean(spark, sf_dir)
    wanted = enrich.new_keys_anti(rows, rows.filter(F.col("batch_id") < 6), ("hashing_key",))
    return enrich.semi_by_key(rows, wanted, ("hashing_key",)).select("trip_key")


@query(
    "nonzero_improvement",
    "SELECT chunk_id, rmse, percentage_improvement FROM improvements WHERE percentage_improvement <> 0",
    ("improvements",),
)
def nonzero_improvement(spark, sf_dir):
    rows = sequence.improvement_pct(views.scores(spark, sf_dir))
    return stats.nonzero_improvement(rows).select("chunk_id", "rmse", "percentage_improvement")


DATE_TEXT = (
    "SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN '2031-01-01' WHEN 1 THEN '2020-13-01' WHEN 2 THEN '2021-02-32' "
    "WHEN 3 THEN '2021-02-30' WHEN 4 THEN 'soon' WHEN 5 THEN '2021-02-00' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day_text FROM orders"
)


@query(
    "date_string_validation",
    'SELECT o_orderkey, day_text, "check", CASE WHEN "check" = \'ok\' THEN day_text || \'T00:00:00\' END AS threshold FROM ('
    "SELECT *, CASE WHEN y IS NULL OR m IS NULL OR d IS NULL THEN 'invalid_date' WHEN y > 2026 THEN 'invalid_year' "
    "WHEN m > 12 THEN 'invalid_month' WHEN d < 1 OR d > 31 THEN 'invalid_day' "
    "WHEN try_strptime(day_text, '%Y-%m-%d') IS NULL THEN 'invalid_date' ELSE 'ok' END AS \"check\" FROM ("
    "SELECT *, try_cast(split_part(day_text, '-', 1) AS INTEGER) AS y, try_cast(split_part(day_text, '-', 2) AS INTEGER) AS m, "
    f"try_cast(split_part(day_text, '-', 3) AS INTEGER) AS d FROM ({DATE_TEXT})))",
)
def date_string_validation(spark, sf_dir):
    key = F.col("o_orderkey")
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    # Thresholds that are wrong in one way each.
    for remainder, wrong in enumerate(["2031-01-01", "2020-13-01", "2021-02-32", "2021-02-30", "soon", "2021-02-00"]):
        text = F.when(key % 9 == remainder, wrong).otherwise(text)
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day_text"))
    return incremental.date_string_validation(rows, "day_text", YEAR)


@query(
    "valid_request",
    r"""SELECT conv_id FROM request_texts WHERE contains(lower(text), 'from') AND contains(lower(text), 'to')
        AND contains(lower(text), 'for') AND contains(lower(text), 'at')
        AND regexp_matches(regexp_extract(text, '(?i)at\s([\d:]+)', 1), '^\d{2}:\d{2}')""",
    ("request_texts",),
)
def valid_request(spark, sf_dir):
    return requests.valid_request(views.request_texts(spark, sf_dir)).select("conv_id")
