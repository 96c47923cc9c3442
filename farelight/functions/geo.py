"""Planar polygon measures and great-circle distance, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in km.
EARTH_RADIUS_KM = 6371.0087714150598


def rings(coordinates: Column) -> Column:
    """Polygons of rings of points -> rings of points."""
    return F.flatten(coordinates)


def _number_text(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def _ring_text(ring: Column) -> Column:
    points = F.transform(ring, lambda p: F.concat_ws(" ", _number_text(p[0]), _number_text(p[1])))
    return F.concat(F.lit("(("), F.array_join(points, ", "), F.lit("))"))


def multipolygon_wkt(ring_list: Column) -> Column:
    """Every ring becomes a polygon of its own."""
    return F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(ring_list, _ring_text), ", "), F.lit(")"))


def _ring_moments(ring: Column) -> Column:
    """Signed doubled area and first moments of a closed ring, relative to its first point."""
    x0, y0 = ring[0][0], ring[0][1]
    steps = F.size(ring) - 1
    edges = F.zip_with(
        F.slice(ring, F.lit(1), steps),
        F.slice(ring, F.lit(2), steps),
        lambda p, q: F.struct(
            (p[0] - x0).alias("px"),
            (p[1] - y0).alias("py"),
            (q[0] - x0).alias("qx"),
            (q[1] - y0).alias("qy"),
        ),
    )
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def step(acc: Column, e: Column) -> Column:
        cross = e["px"] * e["qy"] - e["qx"] * e["py"]
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["mx"] + (e["px"] + e["qx"]) * cross).alias("mx"),
            (acc["my"] + (e["py"] + e["qy"]) * cross).alias("my"),
        )

    def finish(acc: Column) -> Column:
        return F.struct(
            F.abs(acc["a"] / 2).alias("area"),
            (x0 + acc["mx"] / (3 * acc["a"])).alias("x"),
            (y0 + acc["my"] / (3 * acc["a"])).alias("y"),
        )

    return F.aggregate(edges, zero, step, finish)


def ring_measures(ring_list: Column) -> Column:
    """Per ring: area and centroid."""
    return F.transform(ring_list, _ring_moments)


def polygon_area(ring_list: Column) -> Column:
    """Sum of the ring areas: rings are added, holes are not subtracted."""
    return F.aggregate(ring_measures(ring_list), F.lit(0.0), lambda acc, r: acc + r["area"])


def polygon_centroid_xy(ring_list: Column) -> Column:
    """Area-weighted mean of the ring centroids."""
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return F.aggregate(
        ring_measures(ring_list),
        zero,
        lambda acc, r: F.struct(
            (acc["w"] + r["area"]).alias("w"),
            (acc["x"] + r["area"] * r["x"]).alias("x"),
            (acc["y"] + r["area"] * r["y"]).alias("y"),
        ),
        lambda acc: F.struct((acc["x"] / acc["w"]).alias("x"), (acc["y"] / acc["w"]).alias("y")),
    )


def point_wkt(x: Column, y: Column) -> Column:
    return F.concat(F.lit("POINT ("), _number_text(x), F.lit(" "), _number_text(y), F.lit(")"))


def point_coordinates(point: Column) -> Column:
    """POINT text -> [lon, lat] as text."""
    return F.split(F.regexp_replace(point, r"POINT \(|\)", ""), " ")


def point_x(point: Column) -> Column:
    return F.element_at(point_coordinates(point), 1).cast("double")


def point_y(point: Column) -> Column:
    return F.element_at(point_coordinates(point), -1).cast("double")


def radians(degrees: Column) -> Column:
    return degrees * (math.pi / 180)


def haversine_from_radians(
    lat1: Column, lng1: Column, lat2: Column, lng2: Column, radius: float = EARTH_RADIUS_KM
) -> Column:
    """Great-circle distance; the root is held at 1 so rounding cannot leave asin's domain."""
    dlat = F.pow(F.sin((lat2 - lat1) / 2), 2)
    dlng = F.pow(F.sin((lng2 - lng1) / 2), 2)
    root = F.sqrt(dlat + F.cos(lat1) * F.cos(lat2) * dlng)
    return 2 * radius * F.asin(F.least(root, F.lit(1.0)))


def haversine_km(pickup: Column, dropoff: Column, radius: float = EARTH_RADIUS_KM) -> Column:
    """Distance of two [lon, lat] text arrays."""

    def rad(points: Column, position: int) -> Column:
        return radians(F.element_at(points, position).cast("double"))

    return haversine_from_radians(rad(pickup, -1), rad(pickup, 1), rad(dropoff, -1), rad(dropoff, 1), radius)
