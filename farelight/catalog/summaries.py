"""Queries: aggregations, statistics and the flagship summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelight.catalog import views
from farelight.catalog.registry import query
from farelight.operators import incremental, stats

SPAN = (
    "(CASE WHEN hour(tpep_pickup_datetime) BETWEEN 7 AND 10 OR hour(tpep_pickup_datetime) BETWEEN 16 AND 19 THEN 1 "
    "WHEN hour(tpep_pickup_datetime) >= 20 OR hour(tpep_pickup_datetime) <= 6 THEN 2 ELSE 3 END)::BIGINT"
)


@query(
    "trip_summary",
    f"SELECT trip_type, {SPAN} AS pickup_daytime, count(*) AS n_trips, round(avg(trip_duration), 4) AS mean_duration, "
    "round(avg(trip_distance), 4) AS mean_distance, round(avg(trip_cost), 4) AS mean_cost, "
    "round(avg(haversine_centroid_distance), 4) AS mean_haversine FROM enriched GROUP BY ALL",
    ("enriched",),
)
def trip_summary(spark, sf_dir):
    rows = views.enriched(spark, sf_dir)
    return rows.groupBy("trip_type", "pickup_daytime").agg(
        F.count("*").alias("n_trips"),
        F.round(F.avg("trip_duration"), 4).alias("mean_duration"),
        F.round(F.avg("trip_distance"), 4).alias("mean_distance"),
        F.round(F.avg("trip_cost"), 4).alias("mean_cost"),
        F.round(F.avg("haversine_centroid_distance"), 4).alias("mean_haversine"),
    )


@query(
    "clean_trips",
    "SELECT trip_key, partition_dt, trip_type, hashing_key, trip_duration, round(trip_distance, 6) AS trip_distance, trip_cost, "
    "isodow(tpep_pickup_datetime)::TINYINT AS pickup_weekday, "
    "(tpep_dropoff_datetime::DATE IN (SELECT d FROM holidays))::TINYINT AS dropoff_holiday FROM clean",
    ("clean", "holidays"),
)
def clean_trips(spark, sf_dir):
    return views.clean(spark, sf_dir).select(
        "trip_key", "partition_dt", "trip_type", "hashing_key", "trip_duration",
        F.round("trip_distance", 6).alias("trip_distance"), "trip_cost", "pickup_weekday", "dropoff_holiday",
    )


@query("count_rows", "SELECT count(*) AS n_rows FROM timed", ("timed",))
def count_rows(spark, sf_dir):
    return stats.count_where(views.timed(spark, sf_dir), {})


@query(
    "count_where",
    "SELECT count(*) AS n_rows, count(*) FILTER (trip_distance = 0) AS n_zero_distance, "
    "count(*) FILTER (fare_amount <= 0) AS n_bad_fare FROM kms",
    ("kms",),
)
def count_where(spark, sf_dir):
    conditions = {"n_zero_distance": F.col("trip_distance") == 0, "n_bad_fare": F.col("fare_amount") <= 0}
    return stats.count_where(views.kms(spark, sf_dir), conditions)


@query(
    "mean_nonzero",
    "SELECT batch_id, round(avg(trip_distance) FILTER (trip_distance <> 0), 6) AS mean_km FROM kms GROUP BY batch_id",
    ("kms",),
)
def mean_nonzero(spark, sf_dir):
    distance = F.col("trip_distance")
    mean = F.avg(F.when(distance != 0, distance))
    return views.kms(spark, sf_dir).groupBy("batch_id").agg(F.round(mean, 6).alias("mean_km"))


@query(
    "quantile_nearest",
    "SELECT trip_type, q, n, value FROM (SELECT trip_type, trip_duration AS value, "
    "row_number() OVER (PARTITION BY trip_type ORDER BY trip_duration) - 1 AS rn, count(*) OVER (PARTITION BY trip_type) AS n FROM clean) "
    "JOIN (VALUES (0.05::DOUBLE), (0.5::DOUBLE), (0.99::DOUBLE)) v(q) ON rn = floor((n - 1) * q + 0.5)",
    ("clean",),
)
def quantile_nearest(spark, sf_dir):
    return stats.nearest_quantiles(views.clean(spark, sf_dir), "trip_duration", [0.05, 0.5, 0.99], ("trip_type",))


@query(
    "quantile_nearest_overall",
    "SELECT q, n, value FROM (SELECT trip_cost AS value, row_number() OVER (ORDER BY trip_cost) - 1 AS rn, count(*) OVER () AS n FROM clean) "
    "JOIN (VALUES (0.05::DOUBLE), (0.99::DOUBLE)) v(q) ON rn = floor((n - 1) * q + 0.5)",
    ("clean",),
)
def quantile_nearest_overall(spark, sf_dir):
    return stats.nearest_quantiles(views.clean(spark, sf_dir), "trip_cost", [0.05, 0.99])


@query(
    "quantile_trim_overall",
    "SELECT count(*) AS n_rows, min(trip_duration) AS low, max(trip_duration) AS high FROM clean WHERE trip_duration BETWEEN "
    "(SELECT floor(trip_duration) FROM (SELECT trip_duration, row_number() OVER (ORDER BY trip_duration) - 1 AS rn, count(*) OVER () AS n FROM clean) "
    "WHERE rn = floor((n - 1) * 0.05::DOUBLE + 0.5)) AND "
    "(SELECT trip_duration FROM (SELECT trip_duration, row_number() OVER (ORDER BY trip_duration) - 1 AS rn, count(*) OVER () AS n FROM clean) "
    "WHERE rn = floor((n - 1) * 0.99::DOUBLE + 0.5))",
    ("clean",),
)
def quantile_trim_overall(spark, sf_dir):
    rows = stats.quantile_trim(views.clean(spark, sf_dir), "trip_duration")
    return rows.agg(
        F.count("*").alias("n_rows"), F.min("trip_duration").alias("low"), F.max("trip_duration").alias("high")
    )


@query(
    "describe_std",
    "SELECT trip_type, round(stddev_samp(trip_duration), 6) AS std, count(trip_duration) AS n FROM clean GROUP BY trip_type",
    ("clean",),
)
def describe_std(spark, sf_dir):
    rows = stats.describe_std(views.clean(spark, sf_dir), "trip_duration", ("trip_type",))
    return rows.withColumn("std", F.round("std", 6))


@query("max_event_time", "SELECT page_id, max_date FROM pages", ("pages",))
def max_event_time(spark, sf_dir):
    return incremental.max_event_time(views.event_pages(spark, sf_dir), "ts", "page_id")


@query("sort_desc_take1", "SELECT event_type, max(ts) AS max_date FROM events GROUP BY event_type")
def sort_desc_take1(spark, sf_dir):
    return incremental.max_event_time(views.table(spark, sf_dir, "events"), "ts", "event_type")


@query("high_water_mark", "SELECT max(date_trunc('microsecond', max_date)) AS mark FROM pages", ("pages",))
def high_water_mark(spark, sf_dir):
    pages = incremental.max_event_time(views.event_pages(spark, sf_dir), "ts", "page_id")
    return incremental.high_water_mark(incremental.checkpoint_rows(pages, "20261231"))


LATEST = """
    SELECT source_id, strptime(latest_lnd_folder, '%Y%m%d')::DATE AS last_processed,
           strptime(latest_unprocessed_folder, '%Y%m%d')::DATE AS unprocessed, status
    FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY latest_lnd_folder DESC, seq) AS rn FROM status_log) WHERE rn = 1"""


@query("latest_status", LATEST, ("status_log",))
def latest_status(spark, sf_dir):
    return incremental.latest_status(views.status_log(spark, sf_dir), ("source_id",))


@query(
    "processing_gate",
    f"SELECT *, reason IN ('new_folder', 'unprocessed_folder') AS run FROM (SELECT *, CASE WHEN landing_day > last_processed THEN 'new_folder' "
    "WHEN unprocessed IS NOT NULL AND status = 'unprocessed' THEN 'unprocessed_folder' "
    "WHEN unprocessed IS NOT NULL AND status = 'processed' THEN 'already_processed' ELSE 'no_unprocessed_folder' END AS reason "
    f"FROM (SELECT *, DATE '1999-06-01' + (source_id % 900)::INTEGER AS landing_day FROM ({LATEST})))",
    ("status_log",),
)
def processing_gate(spark, sf_dir):
    status = incremental.latest_status(views.status_log(spark, sf_dir), ("source_id",))
    day = F.date_add(F.lit("1999-06-01").cast("date"), (F.col("source_id") % 900).cast("int"))
    return incremental.processing_gate(status.withColumn("landing_day", day))


@query(
    "status_upsert",
    """SELECT source_id, seq, latest_lnd_folder, latest_unprocessed_folder,
              CASE WHEN flip AND is_newest THEN 'processed' ELSE status END AS status, execution_dt
       FROM (SELECT l.*, n.seq = l.seq AS is_newest, n.flip FROM status_log l JOIN newest_status n USING (source_id))
       UNION ALL
       SELECT source_id, last_seq + 1, '20020101', '20020101', 'unprocessed', '20020102' FROM newest_status
       WHERE NOT flip AND source_id % 2 = 0""",
    ("newest_status",),
)
def status_upsert(spark, sf_dir):
    history = views.status_log(spark, sf_dir)
    source = F.col("source_id")
    # A run per source: it finished the folder the newest entry names, or another one.
    newest = history.groupBy("source_id").agg(
        F.max_by("latest_unprocessed_folder", F.struct(F.col("execution_dt"), -F.col("seq"))).alias("open")
    )
    starts = source % 2 == 0
    runs = newest.select(
        "source_id",
        F.when(source % 3 == 0, F.col("open")).otherwise("19000101").alias("folder"),
        F.when(starts, "20020101").alias("latest_lnd_folder"),
        F.when(starts, "20020101").alias("latest_unprocessed_folder"),
        F.when(starts, "unprocessed").alias("status"),
        F.when(starts, "20020102").alias("execution_dt"),
    )
    return incremental.status_upsert(history, runs, ("source_id",))


@query(
    "rmse_r2_mae",
    "SELECT batch_id, count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse, round(1 - avg(e * e) / var_pop(trip_duration), 6) AS r2, "
    "round(avg(abs(e)), 6) AS mae FROM (SELECT *, trip_duration - (trip_distance * 2 + 5) AS e FROM kms) GROUP BY batch_id",
    ("kms",),
)
def rmse_r2_mae(spark, sf_dir):
    rows = views.kms(spark, sf_dir).withColumn("prediction", F.col("trip_distance") * 2 + 5)
    found = stats.regression_metrics(rows, "trip_duration", "prediction", ("batch_id",))
    return found.select("batch_id", "n", *[F.round(m, 6).alias(m) for m in ("rmse", "r2", "mae")])


RESIDUALS = "(SELECT trip_duration - (trip_distance * 2 + 5) AS residual FROM kms)"


def _residuals(spark, sf_dir):
    rows = views.kms(spark, sf_dir)
    return rows.select((F.col("trip_duration") - (F.col("trip_distance") * 2 + 5)).alias("residual"))


@query(
    "residual_histogram",
    "SELECT bin, round(any_value(lo + bin * width), 6) AS low, round(any_value((lo + bin * width) + width), 6) AS high, count(*) AS n FROM ("
    "SELECT lo, width, least(floor((residual - lo) / width), 29)::BIGINT AS bin FROM "
    f"{RESIDUALS}, (SELECT min(residual) AS lo, (max(residual) - min(residual)) / 30 AS width FROM {RESIDUALS})) GROUP BY bin",
    ("kms",),
)
def residual_histogram(spark, sf_dir):
    rows = stats.residual_histogram(_residuals(spark, sf_dir))
    return rows.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


@query(
    "residual_kde",
    # Residuals are shared linearly between grid points, as the operator says.
    "SELECT round(x, 6) AS x, round(sum(w * exp(-0.5 * ((lo + cell * gap - x) / b) ** 2)) / (any_value(n) * any_value(b) * sqrt(2 * pi())), 8) AS density "
    f"FROM (WITH r AS (SELECT residual FROM {RESIDUALS}), s AS (SELECT *, (hi - lo) / ceil((hi - lo) / (b / 32)) AS gap FROM ("
    "SELECT min(residual) AS lo, max(residual) AS hi, count(*) AS n, stddev_samp(residual) * count(*) ** (-0.2::DOUBLE) AS b FROM r)), "
    "p AS (SELECT (residual - lo) / gap AS place FROM r, s), "
    "g AS (SELECT cell, sum(w) AS w FROM (SELECT floor(place) AS cell, 1 - (place - floor(place)) AS w FROM p "
    "UNION ALL SELECT floor(place) + 1, place - floor(place) FROM p) GROUP BY cell) "
    "SELECT g.*, s.*, lo + (hi - lo) * i / 29 AS x FROM g, s, range(30) t(i)) GROUP BY x",
    ("kms",),
)
def residual_kde(spark, sf_dir):
    rows = stats.residual_kde(_residuals(spark, sf_dir))
    return rows.select(F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query("best_score", "SELECT chunk_id, rmse, r2, mae FROM scores ORDER BY rmse, chunk_id LIMIT 1", ("scores",))
def best_score(spark, sf_dir):
    return stats.best_score(views.scores(spark, sf_dir))


@query(
    "ensemble_mean",
    "SELECT trip_key, round((trip_distance * 2 + 5 + trip_distance * 3 + (20 + trip_distance)) / 3, 2) AS prediction FROM kms",
    ("kms",),
)
def ensemble_mean(spark, sf_dir):
    from pyspark.ml.feature import SQLTransformer

    from farelight.operators.models import ensemble_mean as mean_of

    # Three fixed linear rules stand for members of an ensemble.
    members = [
        SQLTransformer(statement=f"SELECT *, {rule} AS prediction FROM __THIS__")
        for rule in ("trip_distance * 2 + 5", "trip_distance * 3", "20 + trip_distance")
    ]
    rows = mean_of(views.kms(spark, sf_dir).select("trip_key", "trip_distance"), members, "prediction")
    return rows.select("trip_key", "prediction")


@query(
    "frame_shape",
    "SELECT count(*) AS n_rows, 6 AS n_columns, 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' AS column_names FROM part",
)
def frame_shape(spark, sf_dir):
    return stats.frame_shape(views.table(spark, sf_dir, "part"))


@query("limit1_exists", "SELECT count(*) > 0 AS has_rows FROM clean WHERE trip_type = 'long_trip'", ("clean",))
def limit1_exists(spark, sf_dir):
    rows = views.clean(spark, sf_dir).filter(F.col("trip_type") == "long_trip")
    return rows.limit(1).agg((F.count("*") > 0).alias("has_rows"))


@query(
    "union_all",
    "SELECT trip_key, batch_id FROM trips WHERE batch_id < 3 UNION ALL SELECT trip_key, batch_id FROM trips WHERE batch_id >= 2",
    ("trips",),
)
def union_all(spark, sf_dir):
    from farelight.sources.landing import multi_file_concat

    rows = views.trips(spark, sf_dir).select("trip_key", "batch_id")
    low, high = rows.filter(F.col("batch_id") < 3), rows.filter(F.col("batch_id") >= 2)
    return multi_file_concat([low, high], rows.schema, spark)


@query(
    "split_by_flag",
    "SELECT trip_type, partition_dt, count(*) AS n_rows FROM clean GROUP BY ALL",
    ("clean",),
)
def split_by_flag(spark, sf_dir):
    from farelight.session import work_path
    from farelight.sources.sinks import rerun_overwrite
    from farelight.sources.tables import table_scan

    path = work_path(spark, "split")
    rerun_overwrite(views.clean(spark, sf_dir), path)
    parts = [table_scan(spark, path).filter(F.col("trip_type") == kind) for kind in ("short_trip", "long_trip")]
    return parts[0].unionByName(parts[1]).groupBy("trip_type", "partition_dt").agg(F.count("*").alias("n_rows"))

