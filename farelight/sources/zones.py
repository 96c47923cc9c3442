"""Zone files: raw nested polygons and the processed zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_ZONE_SCHEMA = """
    objectid string, location_id string, zone string, borough string,
    shape_leng string, shape_area string,
    the_geom struct<type: string, coordinates: array<array<array<array<double>>>>>
"""

ZONE_SCHEMA = """
    objectid string, location_id string, zone string, borough string,
    multipolygons string, polygon_area double, polygon_centroid string
"""

JOIN_COLUMNS = ("objectid", "zone", "polygon_area", "polygon_centroid")


def zones_raw_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(RAW_ZONE_SCHEMA).option("multiLine", multi_line).json(path)


def zones_scan(spark: SparkSession, path: str, columns: tuple[str, ...] = JOIN_COLUMNS) -> DataFrame:
    """The processed dimension, only the columns the joins need."""
    return spark.read.schema(ZONE_SCHEMA).json(path).select(*columns)
