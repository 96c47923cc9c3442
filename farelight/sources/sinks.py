"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farelight.session import freed_shuffles
from farelight.sources.tables import PARTITION_COLUMNS

# About 1 GB of trips per file, so that large months make several.
ROWS_PER_FILE = 5_000_000


def _by_partition(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Gather rows of a directory before the write, which bounds the number of files.

    ``rebalance`` lets adaptive execution split a large month over several tasks and merge
    small ones, so no month depends on a single task.
    """
    return df.hint("rebalance", *columns)


def partitioned_append(df: DataFrame, path: str, columns: tuple[str, ...] = PARTITION_COLUMNS) -> int:
    """Append the rows and return their number, which the write itself counts."""
    written = Observation()
    # Above the exchange: an exchange of no rows is cut out of the plan with all that is below it.
    (
        _by_partition(df, columns)
        .observe(written, F.count(F.lit(1)).alias("n"))
        .write.mode("append")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*columns)
        .parquet(path)
    )
    return written.get["n"]


def rerun_overwrite(df: DataFrame, path: str, columns: tuple[str, ...] = PARTITION_COLUMNS) -> None:
    """Write a day's output so that running the day again replaces it."""
    (
        _by_partition(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*columns)
        .parquet(path)
    )


def overwrite_months(df: DataFrame, path: str, columns: tuple[str, ...] = PARTITION_COLUMNS) -> None:
    """Replace only the partitions present in ``df``."""
    (
        _by_partition(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*columns)
        .parquet(path)
    )


def ndjson_sink(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def json_array_sink(
    df: DataFrame, path: str, page: Column, mode: str = "error", one_per_file: bool = False, compression: str = "none"
) -> None:
    """JSON array documents, one per page and line, or one per file.

    ``page`` bounds a document that is a line: it has to come from a row index divided by a page size. A document that is a
    file, below a folder ``page=...``, is written row by row, so its size is not bound by memory.
    """
    if one_per_file:
        here = W.partitionBy("page").orderBy("page")
        rows = df.select(page.alias("page"), F.struct(*df.columns).alias("row"))
        rows = rows.withColumns({"at": F.row_number().over(here), "more": F.lead(F.lit(True), 1, False).over(here)})
        value = F.concat(
            F.when(F.col("at") == 1, "[").otherwise(","), F.to_json("row", {"ignoreNullFields": "false"}), F.when(F.col("more"), "").otherwise("]")
        )
        with freed_shuffles(df.sparkSession):
            (
                rows.select("page", "at", value.alias("value")).sortWithinPartitions("page", "at").drop("at")
                .write.mode(mode).option("maxRecordsPerFile", 0).option("compression", compression).partitionBy("page").text(path)
            )
        return
    documents = df.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
    lines = documents.select(F.to_json("rows", {"ignoreNullFields": "false"}).alias("value"))
    lines.write.mode(mode).option("compression", compression).text(path)


def csv_sink(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).option("sep", ",").csv(path)
