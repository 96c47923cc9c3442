"""Session settings, shared scratch paths and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast side has to fit comfortably next to everything else on each executor.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 << 20

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Wide projections generate methods the JVM would never compile; beyond this size Spark
    # evaluates the operators one by one, which is several times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "farelight", master: str | None = None, **extra: str) -> SparkSession:
    """Return a session with the settings every job relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    context = spark.sparkContext
    if not context.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        # Shuffles start with many small partitions; adaptive execution merges what is too small.
        spark.conf.set(INITIAL_PARTITIONS, str(max(200, 8 * context.defaultParallelism)))
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results and speed depend on to a session made elsewhere.

    Event times carry no zone; instants are taken as UTC so differences are exact.
    """
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        spark.conf.set(key, SETTINGS[key])
    return spark


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Redistribute a scan that makes fewer tasks than there are cores, by ``columns``.

    Large tables make many tasks and are returned as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *columns) if df.rdd.getNumPartitions() < cores else df


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session may fall back to a folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside free the files of their shuffles when they end, not when the driver happens to collect its garbage.

    That is right for writes, which plan their rows anew each time; a frame that is itself collected twice would shuffle twice.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing a table to the shared folder and reading it back."""
    spark = df.sparkSession
    path = work_path(spark, name)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of ``materialize`` that no frame still to be evaluated reads; other frames are passed over."""
    for table in tables:
        path = None if table is None else table.__dict__.pop("stored_at", None)
        if path:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast when ``df`` is counted and measured to be within ``max_rows`` and ``max_bytes``.

    This runs a job when it is called. The rows are kept for the join, so the check costs no second evaluation, and
    their size is the one they are kept in. Above the
    bounds the frame is stored and returned unhinted: Spark then shuffles both sides of the
    join, and adaptive execution splits partitions of a hot key. It only does so for sides
    that are read and shuffled as they are, hence the table and not the aggregation.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    small = kept.count() <= max_rows
    if small and int(str(kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= max_bytes:
        _KEPT.append(kept)
        return F.broadcast(kept)
    stored = materialize(kept, "side")
    kept.unpersist()
    return stored


_KEPT: list[DataFrame] = []


def release_kept() -> None:
    """Release the small sides kept so far; a later use of one evaluates it again."""
    while _KEPT:
        _KEPT.pop().unpersist()
