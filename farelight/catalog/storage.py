"""Queries: every source and sink, written to the shared folder and read back."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import functions as F

from farelight.catalog import views
from farelight.catalog.registry import query
from farelight.operators import incremental, projection, sequence
from farelight.session import work_path
from farelight.sources import checkpoints, landing, sinks, snapshots, tables
from farelight.sources import zones as zone_files

RAW = "trip_key, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, pulocationid, dolocationid, fare_amount, extra, mta_tax, tolls_amount, improvement_surcharge"

# The raw columns that are read past.
UNUSED = (
    "vendorid passenger_count ratecodeid store_and_fwd_flag payment_type tip_amount total_amount congestion_surcharge".split()
)


# Landing files are packed as text takes a multiple of the tables it is made of; a packed file is read by one task, so it is kept small.
LANDED, ROWS_PER_LANDED = "*.json.gz", 500_000

# Trips of an array that is read by one task, and of one that is cut.
ROWS_PER_ARRAY, ROWS_PER_LARGE_ARRAY = 25_000, 1_000_000


def _write_lines(rows, path: str) -> None:
    rows.drop("batch_id").write.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_LANDED).json(path)


def _write_landing(spark, sf_dir, width: int = 18, by_batch: bool = False):
    """Raw trips as JSON lines with ``width`` columns; ``trip_key`` travels in ``vendorid``."""
    path = work_path(spark, "landing")
    rows = views.raw_trips(spark, sf_dir)
    extra = {name: F.lit("0") for name in UNUSED[1 : width - 10]}
    rows = rows.withColumns({"vendorid": F.col("trip_key"), **extra}).drop("trip_key")
    if by_batch:
        narrow = rows.drop(UNUSED[-1])
        _write_lines(rows.filter("batch_id <> 7"), f"{path}/wide")
        _write_lines(narrow.filter("batch_id = 7"), f"{path}/narrow")
        return [f"{path}/wide", f"{path}/narrow"]
    _write_lines(rows, path)
    return path


def _write_arrays(spark, sf_dir, files: int, most: int, compression: str = "none") -> str:
    """Raw trips in at least so many files of one array, more where arrays would have over ``most`` trips on average."""
    path = work_path(spark, "arrays")
    extra = {name: F.lit("0") for name in UNUSED[1:8]}
    rows = views.raw_trips(spark, sf_dir).withColumns({"vendorid": F.col("trip_key"), **extra}).drop("trip_key", "batch_id")
    files = max(files, -(-views.trips(spark, sf_dir).count() // most))
    sinks.json_array_sink(rows, path, F.pmod(F.xxhash64("vendorid"), F.lit(files)), one_per_file=True, compression=compression)
    return path


WITH_KEY = (*landing.LANDING_COLUMNS, "vendorid")


def _typed(raw):
    return projection.typed_projection(raw.withColumnRenamed("vendorid", "trip_key")).select(*RAW.split(", "))


@query("landing_scan", f"SELECT {RAW} FROM trips", ("trips",))
def landing_scan(spark, sf_dir):
    return _typed(landing.landing_scan(spark, _write_landing(spark, sf_dir), WITH_KEY, multi_line=False, glob=LANDED))


@query("landing_scan_arrays", f"SELECT {RAW} FROM trips", ("trips",))
def landing_scan_arrays(spark, sf_dir):
    """Files that hold one array of documents each."""
    path = _write_arrays(spark, sf_dir, 64, ROWS_PER_ARRAY, "gzip")
    return _typed(landing.landing_scan(spark, path, WITH_KEY, multi_line=True, glob="*.txt.gz"))


@query("landing_scan_large_arrays", f"SELECT {RAW} FROM trips", ("trips",))
def landing_scan_large_arrays(spark, sf_dir):
    """Arrays of many trips, each cut and read by several tasks."""
    path = _write_arrays(spark, sf_dir, 4, ROWS_PER_LARGE_ARRAY)
    return _typed(landing.array_scan(spark, path, WITH_KEY, "*.txt", split_above=100_000))


@query("file_schema_guard", f"SELECT {RAW} FROM trips WHERE batch_id <> 7", ("trips",))
def file_schema_guard(spark, sf_dir):
    paths = _write_landing(spark, sf_dir, by_batch=True)
    return _typed(landing.file_schema_guard(spark, paths, WITH_KEY, multi_line=False, glob=LANDED))


@query("multi_file_concat", f"SELECT {RAW} FROM trips", ("trips",))
def multi_file_concat(spark, sf_dir):
    paths = _write_landing(spark, sf_dir, by_batch=True)
    frames = [landing.landing_scan(spark, p, WITH_KEY, multi_line=False, glob=LANDED) for p in paths]
    return _typed(landing.multi_file_concat(frames, landing.landing_schema(WITH_KEY), spark))


@query(
    "zones_raw_scan",
    "SELECT objectid, zone, shape_leng, 'MultiPolygon' AS type, x / 10000.0::DOUBLE AS first_x, "
    "(1 + has_second::INTEGER)::INTEGER AS n_polygons FROM raw_zones r JOIN parcels p ON r.i = p.i",
    ("raw_zones", "parcels"),
)
def zones_raw_scan(spark, sf_dir):
    path = work_path(spark, "zones_raw")
    sinks.ndjson_sink(views.raw_zones(spark, sf_dir).drop("i"), path)
    rows = zone_files.zones_raw_scan(spark, path, multi_line=False)
    shape = F.col("the_geom.coordinates")
    return rows.select(
        "objectid", "zone", "shape_leng", "the_geom.type", shape[0][0][0][0].alias("first_x"), F.size(shape).alias("n_polygons")
    )


@query(
    "zones_scan",
    "SELECT p_partkey::VARCHAR AS objectid, p_name AS zone, p_retailprice AS polygon_area, concat('POINT (', p_partkey, ' ', p_size, ')') AS polygon_centroid FROM part",
)
def zones_scan(spark, sf_dir):
    path = work_path(spark, "zones")
    text = F.col("p_partkey").cast("string")
    rows = views.table(spark, sf_dir, "part").select(
        text.alias("objectid"), text.alias("location_id"), F.col("p_name").alias("zone"), F.col("p_type").alias("borough"),
        F.lit("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))").alias("multipolygons"), F.col("p_retailprice").alias("polygon_area"),
        F.concat(F.lit("POINT ("), text, F.lit(" "), F.col("p_size").cast("string"), F.lit(")")).alias("polygon_centroid"),
    )
    sinks.ndjson_sink(rows, path)
    return zone_files.zones_scan(spark, path)


STORED = "SELECT trip_key, trip_type, partition_dt, trip_cost FROM clean"


def _stored(spark, sf_dir):
    return views.clean(spark, sf_dir).select("trip_key", "trip_type", "partition_dt", "trip_cost", "batch_id")


@query("partitioned_append", STORED, ("clean",))
def partitioned_append(spark, sf_dir):
    path = work_path(spark, "trips")
    rows = _stored(spark, sf_dir)
    for part in (rows.filter("batch_id < 4"), rows.filter("batch_id >= 4")):
        sinks.partitioned_append(part.drop("batch_id"), path)
    return tables.table_scan(spark, path)


@query("rerun_overwrite", f"{STORED} WHERE batch_id < 4", ("clean",))
def rerun_overwrite(spark, sf_dir):
    path = work_path(spark, "trips")
    rows = _stored(spark, sf_dir)
    for part in (rows, rows.filter("batch_id < 4")):
        sinks.rerun_overwrite(part.drop("batch_id"), path)
    return tables.table_scan(spark, path)


@query("overwrite_months", f"{STORED} WHERE partition_dt <> '199707' OR batch_id < 4", ("clean",))
def overwrite_months(spark, sf_dir):
    path = work_path(spark, "trips")
    rows = _stored(spark, sf_dir)
    month = (F.col("partition_dt") == "199707") & (F.col("batch_id") < 4)
    for part in (rows, rows.filter(month)):
        sinks.overwrite_months(part.drop("batch_id"), path)
    return tables.table_scan(spark, path)


@query("partition_scan", f"{STORED} WHERE partition_dt = '199803'", ("clean",))
def partition_scan(spark, sf_dir):
    path = work_path(spark, "trips")
    sinks.partitioned_append(_stored(spark, sf_dir).drop("batch_id"), path)
    return tables.partition_scan(spark, path, "199803")


@query("partition_literal", "SELECT partition_dt, count(*) AS n_rows FROM clean GROUP BY partition_dt", ("clean",))
def partition_literal(spark, sf_dir):
    path = work_path(spark, "trips")
    sinks.partitioned_append(_stored(spark, sf_dir).drop("batch_id"), path)
    return tables.table_scan(spark, path).groupBy("partition_dt").agg(F.count("*").alias("n_rows"))


@query(
    "training_scan",
    "SELECT trip_duration, round(trip_distance, 6) AS trip_distance, hour(tpep_pickup_datetime)::TINYINT AS pickup_hour, "
    "round(haversine_centroid_distance, 6) AS haversine_centroid_distance FROM enriched WHERE trip_type = 'short_trip'",
    ("enriched",),
)
def training_scan(spark, sf_dir):
    path = work_path(spark, "enriched")
    sinks.partitioned_append(views.enriched(spark, sf_dir).select(*tables.DURATION_COLUMNS, "trip_type", "partition_dt"), path)
    rows = tables.training_scan(spark, path, trip_type="short_trip")
    return rows.select(
        "trip_duration", F.round("trip_distance", 6).alias("trip_distance"), "pickup_hour",
        F.round("haversine_centroid_distance", 6).alias("haversine_centroid_distance"),
    )


@query("ndjson_sink", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def ndjson_sink(spark, sf_dir):
    path = work_path(spark, "orders")
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    sinks.ndjson_sink(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("json_array_sink", "SELECT event_id, user_id, event_type, value FROM events")
def json_array_sink(spark, sf_dir):
    path = work_path(spark, "pages")
    rows = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    sinks.json_array_sink(rows, path, F.floor(F.col("event_id") / 1000))
    return spark.read.schema(rows.schema).json(path)


@query("csv_sink", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def csv_sink(spark, sf_dir):
    path = work_path(spark, "lines")
    rows = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    sinks.csv_sink(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query(
    "latest_snapshot",
    "SELECT '20240517' AS folder_name, count(*) AS n_rows FROM orders WHERE o_orderkey % 2 = 1",
)
def latest_snapshot(spark, sf_dir):
    root = work_path(spark, "snapshots")
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey")
    for remainder, day in enumerate(("20240516", "20240517")):
        sinks.ndjson_sink(rows.filter(F.col("o_orderkey") % 2 == remainder), f"{root}/{day}")
    newest = snapshots.latest_dated_folder(snapshots.list_files(spark, root, "*.json"), root).first()["folder_name"]
    found = spark.read.schema("o_orderkey bigint").json(f"{root}/{newest}")
    return found.agg(F.lit(newest).alias("folder_name"), F.count("*").alias("n_rows"))


@query(
    "latest_by_time",
    "SELECT 'second' AS folder_name, true AS newest_file_inside, count(*) AS n_rows FROM orders WHERE o_orderkey % 2 = 1",
)
def latest_by_time(spark, sf_dir):
    """The newest folder and file by their times, not their names."""
    root = work_path(spark, "by_time")
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey")
    for remainder, name in enumerate(("zz_first", "second")):
        sinks.ndjson_sink(rows.filter(F.col("o_orderkey") % 2 == remainder), f"{root}/{name}")
        # File systems may keep whole seconds only.
        time.sleep(1.1)
    files = snapshots.list_files(spark, root, "*.json")
    newest = snapshots.latest_folder(files, root).first()["folder_name"]
    file = snapshots.latest_file(files, ".json").first()["path"]
    found = spark.read.schema("o_orderkey bigint").json(f"{root}/{newest}")
    return found.agg(
        F.lit(newest).alias("folder_name"), F.lit(f"/{newest}/" in file).alias("newest_file_inside"), F.count("*").alias("n_rows")
    )


def _write_checkpoints(spark, sf_dir):
    path = work_path(spark, "marks")
    pages = incremental.max_event_time(views.event_pages(spark, sf_dir), "ts", "page_id")
    kept = sequence.running_max_checkpoint(pages)
    for part in (F.col("page_id") % 2 == 0, F.col("page_id") % 2 == 1):
        checkpoints.checkpoint_append(incremental.checkpoint_rows(kept.filter(part), "20261231"), path)
    return path


KEPT_PAGES = (
    "(SELECT * FROM (SELECT *, max(max_date) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best "
    "FROM pages) WHERE best IS NULL OR max_date > best)"
)


@query(
    "checkpoint_append",
    f"SELECT strftime(max_date, '%Y-%m-%dT%H:%M:%S.%f') AS max_date, '20261231' AS execution_date FROM {KEPT_PAGES}",
    ("pages",),
)
def checkpoint_append(spark, sf_dir):
    return checkpoints.checkpoint_scan(spark, _write_checkpoints(spark, sf_dir))


@query("checkpoint_scan", f"SELECT max(max_date) AS mark FROM {KEPT_PAGES}", ("pages",))
def checkpoint_scan(spark, sf_dir):
    return incremental.high_water_mark(checkpoints.checkpoint_scan(spark, _write_checkpoints(spark, sf_dir)))


@query(
    "scores_scan",
    "SELECT 'chunk_' || chunk_id::VARCHAR AS chunk, chunk_id, '/models/a' AS model_path, rmse, r2, mae, percentage_improvement FROM improvements",
    ("improvements",),
)
def scores_scan(spark, sf_dir):
    path = work_path(spark, "scores")
    rows = sequence.improvement_pct(views.scores(spark, sf_dir)).withColumn("model_path", F.lit("/models/a"))
    checkpoints.scores_sink(rows, path)
    return checkpoints.scores_scan(spark, path)


@query("scores_sink", "SELECT chunk_id, rmse, r2, mae, percentage_improvement, '/models/a' AS model_path FROM improvements", ("improvements",))
def scores_sink(spark, sf_dir):
    return scores_scan(spark, sf_dir).select("chunk_id", "rmse", "r2", "mae", "percentage_improvement", "model_path")


@query(
    "incremental_ingest",
    "SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '1970-01-01' AND ts <= "
    "(SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)",
)
def incremental_ingest(spark, sf_dir):
    from farelight.streaming.ingest import incremental_ingest as ingest
    from farelight.streaming.ingest import landing_stream

    root = work_path(spark, "ingest")
    events = views.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    for half in range(2):
        events.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{root}/drops")
    stream = landing_stream(spark, f"{root}/drops", events.schema, files_per_batch=1, fmt="parquet")
    ingest(
        stream, "ts", f"{root}/rows", f"{root}/marks", f"{root}/checkpoint", low + (high - low) / 2, "20261231",
        start_mark=datetime(1970, 1, 1),
    )
    return spark.read.schema(events.schema).parquet(f"{root}/rows").select("event_id", "ts", "event_type")


QUARTER, HALF = ("(SELECT min(ts) + (max(ts) - min(ts)) / %d FROM events)" % part for part in (4, 2))


@query(
    "deferred_ingest",
    "SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '1970-01-01' AND "
    f"((event_id % 2 = 0 AND ts <= {HALF}) OR (event_id % 2 = 1 AND ts <= {HALF} "
    f"AND ts > (SELECT max(ts) FROM events WHERE event_id % 2 = 0 AND ts <= {QUARTER})))",
)
def deferred_ingest(spark, sf_dir):
    """Two runs with a later threshold: the second also takes what the first one left of the files it read."""
    from farelight.streaming.ingest import incremental_ingest as ingest
    from farelight.streaming.ingest import landing_stream

    root = work_path(spark, "deferred")
    events = views.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    for half, part in ((0, 4), (1, 2)):
        events.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{root}/drops")
        stream = landing_stream(spark, f"{root}/drops", events.schema, fmt="parquet")
        ingest(
            stream, "ts", f"{root}/rows", f"{root}/marks", f"{root}/checkpoint", low + (high - low) / part, "20261231",
            start_mark=None if half else datetime(1970, 1, 1),
        )
    return spark.read.schema(events.schema).parquet(f"{root}/rows").select("event_id", "ts", "event_type")


@query("dedup_on_key", "SELECT DISTINCT hashing_key FROM clean", ("clean",))
def dedup_on_key(spark, sf_dir):
    from farelight.streaming.dedup import dedup_on_key as dedup
    from farelight.streaming.dedup import run_to_parquet

    root = work_path(spark, "dedup")
    rows = views.clean(spark, sf_dir).select("hashing_key", "tpep_pickup_datetime")
    rows.withColumn("ts", F.col("tpep_pickup_datetime").cast("timestamp")).drop("tpep_pickup_datetime").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("hashing_key string, ts timestamp").parquet(f"{root}/in")
    run_to_parquet(dedup(stream, "ts"), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("hashing_key")


@query(
    "enrich_stream",
    "SELECT trip_key, pu_zone, do_zone, round(haversine_centroid_distance, 6) AS km FROM enriched WHERE batch_id < 4 "
    "UNION ALL SELECT trip_key, pu_zone, do_zone, round(haversine_centroid_distance, 6) FROM enriched "
    "WHERE (trip_type, partition_dt, hashing_key) NOT IN (SELECT (trip_type, partition_dt, hashing_key) FROM enriched WHERE batch_id < 4)",
    ("enriched",),
)
def enrich_stream(spark, sf_dir):
    """Half of the trips, then all of them from where the stream left off: what is stored is not stored again."""
    from farelight.streaming.dedup import enrich_stream as enrich

    root = work_path(spark, "enrich")
    rows = views.clean(spark, sf_dir)
    for part in (rows.filter(F.col("batch_id") < 4), rows):
        part.write.mode("append").option("compression", "zstd").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        enrich(stream, views.zone_dimension(spark), f"{root}/out", f"{root}/checkpoint")
    stored = spark.read.parquet(f"{root}/out")
    return stored.select("trip_key", "pu_zone", "do_zone", F.round("haversine_centroid_distance", 6).alias("km"))
