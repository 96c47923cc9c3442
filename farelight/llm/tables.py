"""Small helpers of the operators: written intermediate tables, size-checked broadcasts, components."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelight.session import discard, materialize

#: A broadcast side has at most so many rows, and at most so many bytes in its written files.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20

#: Rows of an Arrow batch.
BATCH_ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name like ``stem`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def files_bytes(df: DataFrame) -> int:
    """Bytes of the files a written table is read from, by Hadoop's file system."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark._jvm.org.apache.hadoop.fs.Path
    total = 0
    for name in df.inputFiles():
        file = path(name)
        total += file.getFileSystem(conf).getFileStatus(file).getLen()
    return total


def hint_small(stored: DataFrame) -> DataFrame:
    """Hint a broadcast for a table written by ``materialize`` that is counted and measured to be small.

    Otherwise both sides are shuffled; a written side lets adaptive execution split hot keys.
    """
    if stored.count() <= BROADCAST_ROWS and files_bytes(stored) <= BROADCAST_BYTES:
        hinted = F.broadcast(stored)
        hinted.stored_at = stored.__dict__.get("stored_at")
        return hinted
    return stored


def same(left: str, right: str, *columns: str):
    """Null-safe equality of columns of two aliased frames."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def batch_map(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` over batches of at most ``BATCH_ROWS`` rows, as rows may hold long texts.

    The size of batches is a setting of the session; it is the same for all operators here.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of an edge list reaches: rows (node, label), for nodes with edges.

    ``edges`` has columns a and b of an orderable type. Every round gives each node the least of itself
    and its neighbours and contracts the edges by that; nodes that are hashes, hence in random order,
    make the number of edges fall by a constant factor in each round. Rounds are written as tables, each in place of the one before.
    """
    edges = materialize(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")),
            "least",
        )
        before = labels
        if labels is None:
            labels = least
        else:
            moved = least.select(F.col("node").alias("label"), F.col("label").alias("to"))
            labels = materialize(
                labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels"
            )
            discard(before)
        left = least.select(F.col("node").alias("a"), F.col("label").alias("la"))
        right = least.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        done = edges
        edges = materialize(
            edges.join(left, "a").join(right, "b").filter("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(),
            "edges",
        )
        discard(done, None if least is labels else least)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    discard(edges)
    return labels
