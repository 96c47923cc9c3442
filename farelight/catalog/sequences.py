"""Queries: running values, indexes, shuffles and splits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from farelight.catalog import views
from farelight.catalog.registry import query
from farelight.operators import incremental, sequence


@query(
    "running_max_checkpoint",
    "SELECT page_id, max_date FROM (SELECT *, max(max_date) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best "
    "FROM pages) WHERE best IS NULL OR max_date > best",
    ("pages",),
)
def running_max_checkpoint(spark, sf_dir):
    pages = incremental.max_event_time(views.event_pages(spark, sf_dir), "ts", "page_id")
    return sequence.running_max_checkpoint(pages)


@query("improvement_pct", "SELECT chunk_id, rmse, improved, percentage_improvement FROM improvements", ("improvements",))
def improvement_pct(spark, sf_dir):
    rows = sequence.improvement_pct(views.scores(spark, sf_dir))
    return rows.select("chunk_id", "rmse", "improved", "percentage_improvement")


PATIENCE = (
    "SELECT chunk_id, rmse, ((rn - max(CASE WHEN improved THEN rn END) OVER (ORDER BY chunk_id)){wrap})::INTEGER AS patience FROM improvements"
)


@query("patience_counter", PATIENCE.format(wrap=" % 5"), ("improvements",))
def patience_counter(spark, sf_dir):
    return sequence.patience_counter(views.scores(spark, sf_dir), wrap=5).select("chunk_id", "rmse", "patience")


@query("patience_counter_unwrapped", PATIENCE.format(wrap=""), ("improvements",))
def patience_counter_unwrapped(spark, sf_dir):
    return sequence.patience_counter(views.scores(spark, sf_dir)).select("chunk_id", "rmse", "patience")


INDEXED = "(SELECT *, row_number() OVER (ORDER BY file_row) - 1 AS row_index FROM (SELECT *, row_number() OVER () AS file_row FROM lineitem))"
LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("row_index_chunks", f"SELECT {LINE}, row_index // 5000 + 1 AS chunk_id FROM {INDEXED}")
def row_index_chunks(spark, sf_dir):
    rows = sequence.row_index_chunks(views.table(spark, sf_dir, "lineitem"), 5000)
    return rows.select(*LINE.split(", "), "chunk_id")


@query("row_index", f"SELECT {LINE}, row_index FROM {INDEXED}")
def row_index(spark, sf_dir):
    rows = sequence.file_row_index(views.table(spark, sf_dir, "lineitem"))
    return rows.select(*LINE.split(", "), "row_index")


@query(
    "ordered_index",
    "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS row_index FROM events",
)
def ordered_index(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events")
    block = F.floor(F.col("event_id") / sequence.ROWS_PER_BLOCK)
    return sequence.ordered_index(rows, block, ["event_id"]).select("event_id", "row_index")


@query(
    "page_slice",
    "SELECT event_id, page_id FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i, "
    "(row_number() OVER (ORDER BY event_id) - 1) // 250 AS page_id FROM events) WHERE i >= 750",
)
def page_slice(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events")
    block = F.floor(F.col("event_id") / sequence.ROWS_PER_BLOCK)
    indexed = sequence.ordered_index(rows, block, ["event_id"])
    pages = sequence.page_slice(indexed, 750, 2**62)
    return pages.select("event_id", F.floor(F.col("row_index") / 250).alias("page_id"))


@query(
    "incremental_extract",
    "SELECT event_id, ts, (row_number() OVER (ORDER BY event_id) - 1) // 500 AS page_id FROM events "
    "WHERE ts > (SELECT min(ts) + (max(ts) - min(ts)) / 4 FROM events) AND ts <= TIMESTAMP '2030-01-01'",
)
def incremental_extract(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    rows = incremental.incremental_extract(events, "ts", low + (high - low) / 4, datetime(2030, 1, 1))
    block = F.floor(F.col("event_id") / sequence.ROWS_PER_BLOCK)
    indexed = sequence.ordered_index(rows, block, ["event_id"])
    return indexed.select("event_id", "ts", F.floor(F.col("row_index") / 500).alias("page_id"))


SHUFFLED = (
    "(SELECT trip_key, trip_duration, row_number() OVER (ORDER BY md5(concat_ws('|', trip_key, '1234')), trip_key, trip_duration) - 1 AS row_index FROM timed)"
)


def _shuffled(spark, sf_dir):
    rows = views.timed(spark, sf_dir).select("trip_key", "trip_duration")
    return sequence.shuffled_index(rows, ["trip_key"])


@query("seeded_shuffle", f"SELECT trip_key, trip_duration, row_index FROM {SHUFFLED}", ("timed",))
def seeded_shuffle(spark, sf_dir):
    return _shuffled(spark, sf_dir)


@query(
    "exact_split",
    f"SELECT trip_key, row_index <= (SELECT floor(count(*) * 0.2::DOUBLE) FROM timed) AS is_train FROM {SHUFFLED}",
    ("timed",),
)
def exact_split(spark, sf_dir):
    return sequence.exact_split(_shuffled(spark, sf_dir)).select("trip_key", "is_train")


HEAD = "('0x' || substr(md5(concat_ws('|', trip_key, '{seed}')), 1, 8))::BIGINT"


@query("train_test_split", f"SELECT trip_key, {HEAD.format(seed=1234)} % 10000 < 2000 AS is_train FROM trips", ("trips",))
def train_test_split(spark, sf_dir):
    return sequence.hash_split(views.trips(spark, sf_dir), ["trip_key"]).select("trip_key", "is_train")


@query("kfold_assign", f"SELECT trip_key, ({HEAD.format(seed=42)} % 10)::INTEGER AS fold FROM trips", ("trips",))
def kfold_assign(spark, sf_dir):
    return sequence.kfold_assign(views.trips(spark, sf_dir), ["trip_key"]).select("trip_key", "fold")
