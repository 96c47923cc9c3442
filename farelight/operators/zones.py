"""The zone dimension: checked rows, geometry measures and join-ready points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelight.functions import geo
from farelight.operators import cleaning


def valid_zones(raw: DataFrame) -> DataFrame:
    """Rows with fractional lengths and areas, single-token ids and digit-free names."""
    rows = cleaning.regex_keep(raw, ["shape_leng", "shape_area"])
    rows = cleaning.single_token_keep(rows, ["shape_leng", "shape_area", "objectid", "location_id"])
    return cleaning.no_digit_keep(rows, ["zone", "borough"])


def struct_unnest(df: DataFrame, column: str = "the_geom") -> DataFrame:
    return df.select(*[c for c in df.columns if c != column], f"{column}.*")


def zone_measures(df: DataFrame) -> DataFrame:
    """WKT text, area and centroid of the ``coordinates`` column."""
    ring_list = geo.rings(F.col("coordinates"))
    rows = df.withColumn("_rings", ring_list)
    rows = rows.withColumn("_centroid", geo.polygon_centroid_xy(F.col("_rings")))
    return rows.withColumns(
        {
            "multipolygons": geo.multipolygon_wkt(F.col("_rings")),
            "polygon_area": geo.polygon_area(F.col("_rings")),
            "polygon_centroid": geo.point_wkt(F.col("_centroid.x"), F.col("_centroid.y")),
        }
    ).drop("_rings", "_centroid", "coordinates")


def build_zones(raw: DataFrame) -> DataFrame:
    rows = struct_unnest(valid_zones(raw))
    rows = rows.select("objectid", "location_id", "zone", "borough", "coordinates")
    return zone_measures(rows)
