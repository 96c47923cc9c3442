"""Checkpoint rows and model scores kept as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INGEST_SCHEMA = "max_date string, execution_date string"
STATUS_SCHEMA = "latest_lnd_folder string, latest_unprocessed_folder string, status string, execution_dt string"
SCORES_TYPE = (
    "map<string, struct<model_path: string, rmse: double, r2: double, mae: double, percentage_improvement: double>>"
)

SCORES_PER_DOCUMENT = 1000


def checkpoint_scan(spark: SparkSession, path: str, schema: str = INGEST_SCHEMA) -> DataFrame:
    """Checkpoint rows; no rows when nothing was stored yet."""
    from farelight.sources.tables import path_exists

    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def checkpoint_append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("ignoreNullFields", False).json(path)


def scores_sink(scores: DataFrame, path: str, mode: str = "error") -> None:
    """Write (chunk_id, model_path, rmse, r2, mae, percentage_improvement) as score documents.

    A document maps at most ``SCORES_PER_DOCUMENT`` chunks; a short history is one document.
    """
    metrics = F.struct("model_path", "rmse", "r2", "mae", "percentage_improvement")
    entry = F.struct(F.concat(F.lit("chunk_"), F.col("chunk_id")).alias("key"), metrics.alias("value"))
    documents = scores.groupBy(F.floor(F.col("chunk_id") / SCORES_PER_DOCUMENT).alias("part")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("scores")
    )
    documents.select(F.to_json("scores").alias("value")).write.mode(mode).text(path)


def scores_scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per chunk of all score documents."""
    documents = spark.read.text(path, wholetext=False).select(F.from_json("value", SCORES_TYPE).alias("scores"))
    return documents.select(F.explode("scores").alias("chunk", "m")).select(
        "chunk", F.expr("cast(substring(chunk, 7) as bigint)").alias("chunk_id"), "m.*"
    )
