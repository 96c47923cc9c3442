"""Queries: polygons and distances."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelight.catalog import views
from farelight.catalog.registry import query
from farelight.functions import geo
from farelight.operators import requests, zones

# Area and first moments of a parcel, in 1/10000 degrees: outer ring, added hole, shifted copy.
MEASURES = """
    (SELECT i, a, (w * h * (x + w / 2) + CASE WHEN has_hole THEN 1600 * (x + 30) ELSE 0 END
                   + CASE WHEN has_second THEN w * h * (x + 5000 + w / 2) ELSE 0 END) / a / 1e4 AS cx,
               (w * h * (y + h / 2) + CASE WHEN has_hole THEN 1600 * (y + 30) ELSE 0 END
                   + CASE WHEN has_second THEN w * h * (y + h / 2) ELSE 0 END) / a / 1e4 AS cy
     FROM (SELECT *, w * h + CASE WHEN has_hole THEN 1600 ELSE 0 END + CASE WHEN has_second THEN w * h ELSE 0 END AS a FROM parcels))"""


def _rings(spark, sf_dir):
    return views.parcels(spark, sf_dir).withColumn("rings", geo.rings(F.col("the_geom.coordinates")))


@query(
    "ring_flatten",
    "SELECT i, (1 + has_hole::INTEGER + has_second::INTEGER)::INTEGER AS n_rings, x / 10000.0::DOUBLE AS first_x FROM parcels",
    ("parcels",),
)
def ring_flatten(spark, sf_dir):
    return _rings(spark, sf_dir).select("i", F.size("rings").alias("n_rings"), F.col("rings")[0][0][0].alias("first_x"))


def _wkt_ring(x: str, y: str, w: str = "w", h: str = "h", clockwise: bool = False) -> str:
    def number(v: str) -> str:
        return f"regexp_replace((({v}) / 10000.0::DOUBLE)::VARCHAR, '\\.0$', '')"

    corners = [(x, y), (f"{x} + {w}", y), (f"{x} + {w}", f"{y} + {h}"), (x, f"{y} + {h}"), (x, y)]
    if clockwise:
        corners.reverse()
    return "'((' || " + " || ', ' || ".join(f"{number(px)} || ' ' || {number(py)}" for px, py in corners) + " || '))'"


@query(
    "multipolygon_wkt",
    f"SELECT i, 'MULTIPOLYGON (' || {_wkt_ring('x', 'y')} || CASE WHEN has_hole THEN ', ' || "
    f"{_wkt_ring('x + 10', 'y + 10', '40', '40', True)} ELSE '' END || CASE WHEN has_second THEN ', ' || "
    f"{_wkt_ring('x + 5000', 'y')} ELSE '' END || ')' AS wkt FROM parcels",
    ("parcels",),
)
def multipolygon_wkt(spark, sf_dir):
    return _rings(spark, sf_dir).select("i", geo.multipolygon_wkt(F.col("rings")).alias("wkt"))


@query("polygon_area", f"SELECT i, round(a / 1e8, 10) AS polygon_area FROM {MEASURES}", ("parcels",))
def polygon_area(spark, sf_dir):
    return _rings(spark, sf_dir).select("i", F.round(geo.polygon_area(F.col("rings")), 10).alias("polygon_area"))


@query("polygon_centroid", f"SELECT i, round(cx, 8) AS x, round(cy, 8) AS y FROM {MEASURES}", ("parcels",))
def polygon_centroid(spark, sf_dir):
    centre = geo.polygon_centroid_xy(F.col("rings"))
    return _rings(spark, sf_dir).select("i", F.round(centre["x"], 8).alias("x"), F.round(centre["y"], 8).alias("y"))


def _measured(spark, sf_dir):
    rows = zones.struct_unnest(views.parcels(spark, sf_dir)).drop("type")
    return zones.zone_measures(rows)


@query("wkt_point_xy", f"SELECT i, round(cx, 8) AS longitude, round(cy, 8) AS latitude FROM {MEASURES}", ("parcels",))
def wkt_point_xy(spark, sf_dir):
    point = F.col("polygon_centroid")
    return _measured(spark, sf_dir).select(
        "i", F.round(geo.point_x(point), 8).alias("longitude"), F.round(geo.point_y(point), 8).alias("latitude")
    )


@query(
    "centroid_coordinates",
    f"SELECT i, 2 AS n_parts, round(cx, 8) AS lon, round(cy, 8) AS lat FROM {MEASURES}",
    ("parcels",),
)
def centroid_coordinates(spark, sf_dir):
    rows = _measured(spark, sf_dir).withColumn("coordinates", geo.point_coordinates(F.col("polygon_centroid")))
    return rows.select(
        "i",
        F.size("coordinates").alias("n_parts"),
        F.round(F.element_at("coordinates", 1).cast("double"), 8).alias("lon"),
        F.round(F.element_at("coordinates", -1).cast("double"), 8).alias("lat"),
    )


@query(
    "haversine_km",
    "SELECT trip_key, round(haversine_centroid_distance, 6) AS km FROM enriched",
    ("enriched",),
)
def haversine_km(spark, sf_dir):
    rows = views.enriched(spark, sf_dir)
    distance = geo.haversine_km(F.col("pickup_coordinates"), F.col("dropoff_coordinates"))
    return rows.select("trip_key", F.round(distance, 6).alias("km"))


@query(
    "request_distances",
    "SELECT trip_key, round(haversine_centroid_distance, 6) AS km, round(CASE WHEN batch_id = 1 THEN haversine_centroid_distance "
    "ELSE trip_distance END, 6) AS trip_distance FROM enriched",
    ("enriched",),
)
def request_distances(spark, sf_dir):
    rows = views.enriched(spark, sf_dir)
    places = rows.select(
        "trip_key",
        F.when(F.col("batch_id") != 1, F.col("trip_distance")).alias("trip_distance"),
        *[
            F.element_at(f"{end}_coordinates", position).cast("double").alias(f"{end}_{name}")
            for end in ("pickup", "dropoff")
            for name, position in (("lon", 1), ("lat", -1))
        ],
    )
    found = requests.request_distances(places)
    return found.select(
        "trip_key", F.round("haversine_centroid_distance", 6).alias("km"), F.round("trip_distance", 6).alias("trip_distance")
    )


@query(
    "build_zones",
    r"""SELECT r.objectid, r.location_id, r.zone, r.borough, round(a / 1e8, 10) AS polygon_area, round(cx, 8) AS lon, round(cy, 8) AS lat
        FROM raw_zones r JOIN """
    + MEASURES
    + r""" m ON r.i = m.i
        WHERE regexp_matches(shape_leng, '^0\.\d+$') AND regexp_matches(shape_area, '^0\.\d+$')
          AND NOT contains(objectid, ' ') AND NOT contains(location_id, ' ')
          AND NOT regexp_matches(zone, '\d') AND NOT regexp_matches(borough, '\d')""",
    ("raw_zones", "parcels"),
)
def build_zones(spark, sf_dir):
    rows = zones.build_zones(views.raw_zones(spark, sf_dir).drop("i"))
    point = F.col("polygon_centroid")
    return rows.select(
        "objectid", "location_id", "zone", "borough", F.round("polygon_area", 10).alias("polygon_area"),
        F.round(geo.point_x(point), 8).alias("lon"), F.round(geo.point_y(point), 8).alias("lat"),
    )
