"""Raw trip files: JSON documents whose fields all arrive as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelight.session import broadcast_if_small

# The raw columns in use, and the width of a complete raw row.
LANDING_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "pulocationid",
    "dolocationid",
    "fare_amount",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
)
RAW_WIDTH = 18


def landing_schema(columns: tuple[str, ...] = LANDING_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def landing_scan(
    spark: SparkSession,
    path: str | list[str],
    columns: tuple[str, ...] = LANDING_COLUMNS,
    multi_line: bool = True,
    glob: str = "*.json",
) -> DataFrame:
    """All landing files in one scan; the narrow schema prunes the other fields.

    ``multi_line`` reads files holding one JSON array each, large ones in several tasks (``array_scan``). Without it every line is a
    document (an object or an array) and large files can be split. ``batch_id`` names the
    file a row came from.
    """
    if multi_line:
        return array_scan(spark, path, columns, glob)
    return _json_scan(spark, path, columns, False, glob)


def _json_scan(spark: SparkSession, path: str | list[str], columns: tuple[str, ...], multi_line: bool, glob: str, files: Column | None = None) -> DataFrame:
    """Rows of the JSON files that the condition on their metadata lets through; Spark does not open the others."""
    rows = (
        spark.read.schema(landing_schema(columns))
        .option("multiLine", multi_line)
        .option("pathGlobFilter", glob)
        .json(path)
    )
    rows = rows if files is None else rows.filter(files)
    return rows.select(*columns, F.col("_metadata.file_name").alias("batch_id"))


# A piece of an array between two closing braces: an object after a bracket or comma; the end of the array, or all of an empty one.
_OBJECT = r"^\s*[\[,]\s*\{"
_END = r"^\s*\[?\s*\]\s*$"


def _pieces(spark: SparkSession, path: str | list[str], columns: tuple[str, ...], glob: str, files: Column) -> DataFrame:
    """Array files cut at every closing brace, by any number of tasks: the object of each piece, and whether it is one."""
    text = spark.read.option("lineSep", "}").option("pathGlobFilter", glob).text(path).filter(files)
    schema = T.StructType([*landing_schema(columns).fields, T.StructField("_broken", T.StringType())])
    whole = F.concat(F.regexp_replace("value", r"^\s*[\[,]\s*", ""), F.lit("}"))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("batch_id"),
        F.col("value").rlike(_END).alias("ends"),
        F.col("value").rlike(_OBJECT).alias("opens"),
        F.from_json(whole, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("row"),
    )


def array_scan(
    spark: SparkSession,
    path: str | list[str],
    columns: tuple[str, ...] = LANDING_COLUMNS,
    glob: str = "*.json",
    split_above: int | None = None,
) -> DataFrame:
    """Rows of files that hold one JSON array each, as Spark's multi-line reader returns them; large files are split.

    (A number without quotes is text here; only the one or the other keeps zeros at its end.)

    A file beyond ``split_above`` bytes (by default what a task reads) is cut at closing braces. That is right where the objects of the
    array are flat and no text holds a brace. Anywhere else the first piece cut wrongly is not a whole object, which a pass over
    the large files finds: these files, and those that are no closed array, are left to the multi-line reader, a task each.
    """
    if split_above is None:
        split_above = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    large = F.col("_metadata.file_size") > split_above
    rows = _json_scan(spark, path, columns, True, glob, ~large)
    wrong = ~F.col("ends") & ~(F.col("opens") & F.col("row").isNotNull() & F.col("row._broken").isNull())
    about = _pieces(spark, path, columns, glob, large).groupBy("file").agg(F.bool_or(wrong).alias("wrong"), F.count_if("ends").alias("ends"))
    found = about.select("file", (F.col("wrong") | (F.col("ends") != 1)).alias("whole")).collect()
    whole = [r["file"] for r in found if r["whole"]]
    if len(found) > len(whole):
        cut = _pieces(spark, path, columns, glob, large & ~F.col("_metadata.file_path").isin(whole)).filter(~F.col("ends"))
        rows = rows.unionByName(cut.select(*[F.col(f"row.{c}").alias(c) for c in columns], "batch_id"))
    if whole:
        rows = rows.unionByName(_json_scan(spark, path, columns, True, glob, large & F.col("_metadata.file_path").isin(whole)))
    return rows


def _document_keys(document: Column) -> Column:
    """Field names of a document: of the object itself or of the objects in the array."""
    as_array = F.try_variant_get(document, "$", "array<map<string,variant>>")
    as_object = F.try_variant_get(document, "$", "map<string,variant>")
    objects = F.coalesce(as_array, F.array(as_object))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(objects, F.map_keys))))


def file_widths(spark: SparkSession, path: str | list[str], multi_line: bool = True, glob: str = "*.json") -> DataFrame:
    """(batch_id, width): the number of different field names in each file.

    Key lists are made distinct before they are gathered, so a file contributes as many
    rows as it has row shapes.
    """
    documents = (
        spark.read.option("multiLine", multi_line)
        .option("pathGlobFilter", glob)
        .option("singleVariantColumn", "document")
        .json(path)
    )
    shapes = documents.select(
        F.col("_metadata.file_name").alias("batch_id"), _document_keys(F.col("document")).alias("keys")
    ).distinct()
    return (
        shapes.select("batch_id", F.explode("keys").alias("key"))
        .distinct()
        .groupBy("batch_id")
        .agg(F.count("*").alias("width"))
    )


def file_schema_guard(
    spark: SparkSession,
    path: str | list[str],
    columns: tuple[str, ...] = LANDING_COLUMNS,
    width: int = RAW_WIDTH,
    multi_line: bool = True,
    glob: str = "*.json",
) -> DataFrame:
    """Landing rows of the files that have exactly ``width`` columns."""
    complete = file_widths(spark, path, multi_line, glob).filter(F.col("width") == width).select("batch_id")
    return landing_scan(spark, path, columns, multi_line, glob).join(broadcast_if_small(complete), "batch_id", "left_semi")


def multi_file_concat(frames: list[DataFrame], schema: T.StructType, spark: SparkSession) -> DataFrame:
    """Same-schema frames on top of each other; an empty frame when there is none."""
    if not frames:
        return spark.createDataFrame([], schema)
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
