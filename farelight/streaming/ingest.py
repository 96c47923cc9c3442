"""Incremental ingestion of dropped files as a stream.

The stream's own checkpoint remembers which files were read, so a restarted run continues
after the last committed batch. Every batch writes a directory named by its number and
replaces it when the batch is tried again: rows and marks are stored once.

A file is read once, but a threshold may cut through it. Rows above the threshold go to a side table
(``rows/run=R/ingest=N`` by month), and a later run takes them from there as soon as its threshold reaches them. A
run is closed by a record of its threshold, written last. From these records follows which rows of the side table were
taken: no row of it is ever rewritten or removed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelight.operators.incremental import checkpoint_rows, deferred_extract, high_water_mark, incremental_extract
from farelight.session import broadcast_if_small, release_kept
from farelight.sources.checkpoints import INGEST_SCHEMA, checkpoint_scan
from farelight.sources.tables import has_files, path_exists

RUN_SCHEMA = "start string, target string, run int"
CLOSED_SCHEMA = "threshold string, run int"


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None, fmt: str = "json"
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stored_mark(spark: SparkSession, marks: str) -> datetime:
    return high_water_mark(checkpoint_scan(spark, marks, INGEST_SCHEMA + ", ingest int")).first()["mark"]


class DeferredRows:
    """The side table of rows above earlier thresholds, and the records of the runs that filled and emptied it."""

    def __init__(self, spark: SparkSession, path: str, ts: str):
        self.spark, self.path, self.ts = spark, path.rstrip("/"), ts

    def _record(self, kind: str, run: int, **values: str) -> None:
        row = self.spark.createDataFrame([tuple(values.values())], ", ".join(f"{name} string" for name in values))
        row.write.mode("overwrite").json(f"{self.path}/{kind}/run={run}")

    def open_run(self, start: datetime, target: str) -> tuple[int, datetime, str]:
        """The number of this run, its starting mark and its target; a run that broke off is continued with its own."""
        closed = checkpoint_scan(self.spark, f"{self.path}/closed", CLOSED_SCHEMA)
        run = closed.agg(F.coalesce(F.max("run"), F.lit(0)) + 1).first()[0]
        opened = checkpoint_scan(self.spark, f"{self.path}/opened", RUN_SCHEMA).filter(F.col("run") == run).first()
        if opened:
            return run, datetime.fromisoformat(opened["start"]), opened["target"]
        self._record("opened", run, start=start.isoformat(), target=target)
        return run, start, target

    def close_run(self, run: int, threshold: datetime) -> None:
        self._record("closed", run, threshold=threshold.isoformat())

    def folder(self, run: int, number: int) -> str:
        return f"{self.path}/rows/run={run}/ingest={number}"

    def store(self, rows: DataFrame, run: int, number: int) -> None:
        """Keep the rows of a batch, by month, so that a later run reads only months it takes rows of."""
        month = F.date_format(self.ts, "yyyyMM").cast("int")
        rows.withColumn("_month", month).hint("rebalance", "_month").write.mode("overwrite").option("compression", "zstd").partitionBy(
            "_month"
        ).parquet(self.folder(run, number))

    def due(self, run: int, threshold: datetime, schema: T.StructType) -> DataFrame | None:
        """Rows up to the threshold that no earlier run has taken; None if nothing was ever kept.

        A row kept by run k was taken by the first run from k on whose threshold reached it, so what is due lies above the
        greatest threshold of the runs from k on.
        """
        if not has_files(self.spark, f"{self.path}/rows"):
            return None
        kept_schema = T.StructType([*schema.fields, T.StructField("run", T.IntegerType()), T.StructField("_month", T.IntegerType())])
        kept = self.spark.read.schema(kept_schema).parquet(f"{self.path}/rows")
        closed = checkpoint_scan(self.spark, f"{self.path}/closed", CLOSED_SCHEMA).filter(F.col("run") < run)
        since = W.orderBy(F.desc("run"))
        taken = closed.select("run", F.max(F.col("threshold").cast("timestamp_ntz")).over(since).alias("_taken"))
        lowest = F.date_format(F.lit(threshold).cast("timestamp_ntz"), "yyyyMM").cast("int")
        kept = kept.filter((F.col("run") <= run) & (F.col("_month") <= lowest))
        return deferred_extract(kept.join(broadcast_if_small(taken), "run", "left"), self.ts, "_taken", threshold).select(*schema.names)


def incremental_ingest(
    stream: DataFrame,
    ts: str,
    target: str,
    marks: str,
    checkpoint: str,
    threshold: datetime,
    execution_date: str,
    start_mark: datetime | None = None,
    fmt: str = "parquet",
    deferred: str | None = None,
) -> None:
    """Append the rows above the mark the run started with, up to the threshold; advance the mark per batch.

    ``fmt`` is the format of the rows: JSON lines (``json``) are what trip processing reads. ``deferred`` is the folder of the side
    table, by default beside the stream's checkpoint.

    Runs over what is there (``availableNow``) and returns. Rows at or below the starting
    mark are not taken, late ones among them, as the pull loop never asks for them. Rows above the threshold are taken by the
    first later run whose threshold reaches them, from the side table and once; they are stored as ``ingest=-R`` of run R.

    A run that breaks off is continued by the next call with the mark and the target it started with: batches replace what their earlier try
    wrote, and the side table is looked into only after all batches of the stream are committed.
    """
    spark = stream.sparkSession
    side = DeferredRows(spark, deferred or f"{checkpoint.rstrip('/')}-deferred", ts)
    run, start, target = side.open_run(start_mark or stored_mark(spark, marks), target)

    def advance(newest: datetime, number: int, earlier: DataFrame) -> None:
        if newest > high_water_mark(earlier).first()["mark"]:
            mark = spark.createDataFrame([(newest,)], "max_date timestamp_ntz")
            checkpoint_rows(mark, execution_date).write.mode("overwrite").json(f"{marks}/ingest={number}")

    def put(rows: DataFrame, number: int, newest: datetime | None) -> None:
        folder = f"{target}/ingest={number}"
        if newest is not None or path_exists(spark, folder):
            rows.write.mode("overwrite").format(fmt).save(folder)

    def stored_marks() -> DataFrame:
        return checkpoint_scan(spark, marks, INGEST_SCHEMA + ", ingest int")

    def store(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            until = F.lit(threshold).cast("timestamp_ntz")
            above = incremental_extract(rows, ts, start)
            newest, later = above.agg(F.max(F.when(F.col(ts) <= until, F.col(ts))), F.max(F.when(F.col(ts) > until, F.col(ts)))).first()
            # What an earlier try of the batch wrote under another threshold is replaced, also by no rows.
            if later is not None or path_exists(spark, side.folder(run, number)):
                side.store(above.filter(F.col(ts) > until), run, number)
            put(above.filter(F.col(ts) <= until), number, newest)
            if newest is not None:
                advance(newest, number, stored_marks().filter(F.col("ingest") < number))
        finally:
            rows.unpersist()

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    due = side.due(run, threshold, stream.schema)
    if due is not None:
        due = due.persist()
        try:
            newest = due.agg(F.max(ts)).first()[0]
            put(due, -run, newest)
            if newest is not None:
                advance(newest, -run, stored_marks().filter(F.col("ingest") != -run))
        finally:
            due.unpersist()
            release_kept()
    side.close_run(run, threshold)
