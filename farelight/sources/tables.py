"""Month-partitioned trip tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_COLUMNS = ("trip_type", "partition_dt")

# Ordered model columns, the target first.
DURATION_COLUMNS = (
    "trip_duration",
    "trip_distance",
    "pickup_daytime",
    "pickup_hour",
    "pickup_weekday",
    "pickup_quarter",
    "pickup_seconds",
    "pickup_holiday",
    "pickup_weekend",
    "haversine_centroid_distance",
)
COST_COLUMNS = (
    "trip_cost",
    "trip_duration",
    "pickup_daytime",
    "dropoff_daytime",
    "pickup_hour",
    "dropoff_hour",
    "pickup_weekday",
    "dropoff_weekday",
    "pickup_quarter",
    "dropoff_quarter",
    "pickup_seconds",
    "dropoff_seconds",
    "pickup_holiday",
    "dropoff_holiday",
    "pickup_weekend",
    "dropoff_weekend",
    "haversine_centroid_distance",
)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def has_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """Whether a table folder has a file of rows; a first append without rows leaves a folder that has none."""
    if not path_exists(spark, path):
        return False
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(hadoop_path, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(suffix):
            return True
    return False


def table_scan(spark: SparkSession, path: str) -> DataFrame:
    """The whole table; months stay text (``yyyyMM``) through the cast."""
    df = spark.read.parquet(path)
    if "partition_dt" in df.columns:
        df = df.withColumn("partition_dt", F.col("partition_dt").cast("string"))
    return df


def partition_scan(
    spark: SparkSession, path: str, partition_dt: str, schema=None, trip_type: str | None = None
) -> DataFrame:
    """Rows of one month, its value as a column; only that directory is listed as input.

    An empty frame of ``schema`` when the table does not exist yet.
    """
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(path).filter(F.col("partition_dt") == partition_dt)
    if trip_type is not None:
        rows = rows.filter(F.col("trip_type") == trip_type)
    return rows.withColumn("partition_dt", F.lit(partition_dt))


def training_scan(
    spark: SparkSession, path: str, columns: tuple[str, ...] = DURATION_COLUMNS, trip_type: str | None = None
) -> DataFrame:
    """Ordered model columns of all months; the scan reads nothing else."""
    rows = spark.read.parquet(path)
    if trip_type is not None and "trip_type" in rows.columns:
        rows = rows.filter(F.col("trip_type") == trip_type)
    return rows.select(*columns)
