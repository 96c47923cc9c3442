"""Choosing the newest file or folder of a location."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, folder, name, modified, length) of all files below ``path``.

    The content column is pruned, so files are listed and not opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
        F.regexp_extract("path", "([^/]*)$", 1).alias("name"),
        F.col("modificationTime").alias("modified"),
        "length",
    )


def latest_file(files: DataFrame, suffix: str = "") -> DataFrame:
    """One row: the newest file whose name ends in ``suffix`` (null when there is none)."""
    matching = files.filter(F.col("name").endswith(suffix))
    newest = F.max_by("path", F.struct("modified", "path"))
    return matching.agg(newest.alias("path"), F.max("modified").alias("modified"))


def latest_folder(files: DataFrame, below: str) -> DataFrame:
    """One row: the newest non-empty direct subfolder of ``below``.

    A folder is as new as its newest file; folders without files do not occur here.
    """
    base = below.rstrip("/")
    child = F.regexp_extract("path", f"{base.split(':', 1)[-1]}/([^/]+)/", 1)
    folders = files.select(child.alias("folder_name"), "modified").filter(F.col("folder_name") != "")
    return folders.agg(
        F.max_by("folder_name", F.struct("modified", "folder_name")).alias("folder_name"),
        F.max("modified").alias("modified"),
    )


def latest_dated_folder(files: DataFrame, below: str) -> DataFrame:
    """One row: the subfolder named by the greatest ``yyyyMMdd`` date."""
    base = below.rstrip("/")
    child = F.regexp_extract("path", f"{base.split(':', 1)[-1]}/([0-9]{{8}})/", 1)
    return files.select(child.alias("folder_name")).filter(F.col("folder_name") != "").agg(
        F.max("folder_name").alias("folder_name")
    )
