import math

import pytest
from pyspark.sql import functions as F

from farelight.functions import geo
from farelight.operators import zones
from farelight.sources.zones import RAW_ZONE_SCHEMA

SQUARE = [[0.0, 0.0], [2.0, 0.0], [2.0, 1.0], [0.0, 1.0], [0.0, 0.0]]
HOLE = [[0.5, 0.25], [0.5, 0.75], [1.5, 0.75], [1.5, 0.25], [0.5, 0.25]]
FAR = [[10.0, 10.0], [11.0, 10.0], [11.0, 11.0], [10.0, 11.0], [10.0, 10.0]]


def measure(spark, coordinates):
    rows = spark.createDataFrame([(coordinates,)], "coordinates array<array<array<array<double>>>>")
    return zones.zone_measures(rows).first()


def test_rectangle(spark):
    row = measure(spark, [[SQUARE]])
    assert row["polygon_area"] == 2.0
    assert row["polygon_centroid"] == "POINT (1 0.5)"
    assert row["multipolygons"] == "MULTIPOLYGON (((0 0, 2 0, 2 1, 0 1, 0 0)))"


def test_clockwise_ring_has_the_same_measures(spark):
    row = measure(spark, [[SQUARE[::-1]]])
    assert row["polygon_area"] == 2.0 and row["polygon_centroid"] == "POINT (1 0.5)"


def test_hole_is_added(spark):
    row = measure(spark, [[SQUARE, HOLE]])
    assert row["polygon_area"] == 2.5
    assert row["multipolygons"] == (
        "MULTIPOLYGON (((0 0, 2 0, 2 1, 0 1, 0 0)), ((0.5 0.25, 0.5 0.75, 1.5 0.75, 1.5 0.25, 0.5 0.25)))"
    )


def test_two_polygons_weigh_by_area(spark):
    row = measure(spark, [[SQUARE], [FAR]])
    assert row["polygon_area"] == pytest.approx(3.0)
    x, y = map(float, row["polygon_centroid"][7:-1].split(" "))
    assert x == pytest.approx((2 * 1 + 10.5) / 3) and y == pytest.approx((2 * 0.5 + 10.5) / 3)


def test_point_text(spark):
    rows = spark.createDataFrame([("POINT (-73.9 40.1)",)], "p string")
    row = rows.select(geo.point_coordinates(F.col("p")).alias("c"), geo.point_x(F.col("p")).alias("x"), geo.point_y(F.col("p")).alias("y")).first()
    assert row["c"] == ["-73.9", "40.1"] and (row["x"], row["y"]) == (-73.9, 40.1)


def test_haversine(spark):
    rows = spark.createDataFrame([(["-73.9", "40.1"], ["-74.1", "40.7"]), (["1", "2"], ["1", "2"]), (["0", "0"], ["180", "0"])], "a array<string>, b array<string>")
    got = [r[0] for r in rows.select(geo.haversine_km(F.col("a"), F.col("b"))).collect()]
    a, b = (math.radians(40.1), math.radians(-73.9)), (math.radians(40.7), math.radians(-74.1))
    h = math.sin((b[0] - a[0]) / 2) ** 2 + math.cos(a[0]) * math.cos(b[0]) * math.sin((b[1] - a[1]) / 2) ** 2
    assert got[0] == pytest.approx(2 * geo.EARTH_RADIUS_KM * math.asin(math.sqrt(h)))
    assert got[1] == 0.0
    assert got[2] == pytest.approx(math.pi * geo.EARTH_RADIUS_KM)


def test_zone_rules(spark):
    geom = ("MultiPolygon", [[SQUARE]])
    good = ("1", "1", "Astoria", "Queens", "0.1", "0.02", geom)
    bad = [
        ("2", "2", "Pier 40", "Queens", "0.1", "0.02", geom), ("3", "3", "Astoria", "Queens", "1.5", "0.02", geom),
        ("4", "4", "Astoria", "Queens", "0.1 0.2", "0.02", geom), ("5 5", "5", "Astoria", "Queens", "0.1", "0.02", geom),
        ("6", "6", "Astoria", "Queens", "0.1", "", geom),
    ]
    built = zones.build_zones(spark.createDataFrame([good, *bad], RAW_ZONE_SCHEMA)).collect()
    assert [r["objectid"] for r in built] == ["1"]
    assert built[0].asDict().keys() == {"objectid", "location_id", "zone", "borough", "multipolygons", "polygon_area", "polygon_centroid"}
