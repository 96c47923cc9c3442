"""Trip, zone, checkpoint and request views over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farelight.catalog.registry import AS_OF, HOLIDAY_YEARS
from farelight.functions.calendar import us_holidays
from farelight.operators import cleaning, enrich, projection, stats, zones
from farelight.plans.processing import clean_trips, measured_trips
from farelight.session import spread, work_path
from farelight.sources.landing import LANDING_COLUMNS
from farelight.sources.tables import path_exists

HOLIDAYS = us_holidays(*HOLIDAY_YEARS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STAGED: dict[tuple[str, str], tuple[str, StructType]] = {}


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged trips of a test folder; written on first use in an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED or not path_exists(spark, f"{_STAGED[key][0]}/_SUCCESS"):
        path = stage_trips(spark, sf_dir)
        _STAGED[key] = path, spark.read.parquet(path).schema
    path, schema = _STAGED[key]
    return spark.read.schema(schema).parquet(path)


def stage_trips(spark: SparkSession, sf_dir: str) -> str:
    """Write the trips as a table in the shared folder, as collection would leave them."""
    path = work_path(spark, "trips")
    derived_trips(spark, sf_dir).write.option("compression", "zstd").parquet(path)
    return path


def derived_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trip per line item."""
    order, part, supplier, line = (F.col(f"l_{c}") for c in ("orderkey", "partkey", "suppkey", "linenumber"))
    late = F.when(order % 499 == 0, 40000 * 86400).otherwise(0)
    pickup = F.timestamp_add("SECOND", late + (order * 7 + part) % 1440 * 60 + supplier % 60, F.col("l_shipdate"))
    ride = (part * 37 + line * 11) % 5400 - 30
    columns = [f"l_{c}" for c in ("orderkey", "partkey", "suppkey", "linenumber", "quantity", "extendedprice", "shipdate")]
    lines = spread(table(spark, sf_dir, "lineitem").select(*columns), "l_orderkey", "l_partkey", "l_linenumber")
    rows = lines.withColumn("tpep_pickup_datetime", pickup)
    sign = F.when(part % 97 == 0, -1).otherwise(1)
    return rows.select(
        (order * 10 + line).alias("trip_id"),
        F.concat_ws("-", order, line, part, supplier).alias("trip_key"),
        "l_orderkey",
        (order % 8).alias("batch_id"),
        "tpep_pickup_datetime",
        F.timestamp_add("SECOND", ride, F.col("tpep_pickup_datetime")).alias("tpep_dropoff_datetime"),
        F.when(part % 41 == 0, 0.0).otherwise(F.col("l_quantity") * 0.6).alias("trip_distance"),
        ((supplier * 13 + line) % 265 + 1).cast("string").alias("pulocationid"),
        (part % 265 + 1).cast("string").alias("dolocationid"),
        (sign * (F.floor(F.col("l_extendedprice") / 1000) + 0.5 * (part % 2))).alias("fare_amount"),
        F.when(part % 113 == 0, -1.0).otherwise(0.5 * (line % 3)).alias("extra"),
        F.when(part % 127 == 0, -0.5).otherwise(0.5).alias("mta_tax"),
        F.when(supplier % 10 == 0, 6.12).otherwise(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as landing text: the ten columns in use, ``trip_key`` and ``batch_id``."""
    rows = trips(spark, sf_dir)
    text = {}
    for name in LANDING_COLUMNS:
        kind = projection.LANDING_TYPES[name]
        if kind == "datetime":
            text[name] = F.date_format(name, projection.DATETIME_FORMAT)
        else:
            text[name] = F.col(name).cast("string")
    return rows.select("trip_key", "batch_id", *[c.alias(n) for n, c in text.items()])


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.trip_duration(trips(spark, sf_dir))


def kms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.distance_km(timed(spark, sf_dir))


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured_trips(trips(spark, sf_dir), HOLIDAYS)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(trips(spark, sf_dir), AS_OF, HOLIDAYS)


def _ring(x: Column, y: Column, w: Column, h: Column, clockwise: bool = False) -> Column:
    """A closed rectangle from its corner and size in 1/10000 degrees."""

    def point(px: Column, py: Column) -> Column:
        return F.array(px / 10000.0, py / 10000.0)

    corners = [point(x, y), point(x + w, y), point(x + w, y + h), point(x, y + h), point(x, y)]
    return F.array(*(reversed(corners) if clockwise else corners))


def zone_dimension(spark: SparkSession) -> DataFrame:
    """Processed zones with the ids 1..263; ids 264 and 265 have none."""
    i = F.col("id")
    x, y = -742500 + 300 * (i % 20), 405000 + 300 * F.floor(i / 20)
    ring = _ring(x, y, 100 + 5 * (i % 7), 100 + 5 * (i % 5))
    rows = spark.range(1, 264).select(
        i.cast("string").alias("objectid"),
        i.cast("string").alias("location_id"),
        F.concat(F.lit("Zone "), F.translate(i.cast("string"), "0123456789", "abcdefghij")).alias("zone"),
        F.lit("Borough").alias("borough"),
        F.array(F.array(ring)).alias("coordinates"),
    )
    return zones.zone_measures(rows)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_trips(clean(spark, sf_dir), zone_dimension(spark))


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested multipolygon per part: one in three has a hole, one in five a second polygon."""
    i = F.col("p_partkey")
    x, y = -742500 + 300 * (i % 20), 405000 + 300 * (F.floor(i / 20) % 20)
    w, h = 100 + 5 * (i % 7), 100 + 5 * (i % 5)
    outer = _ring(x, y, w, h)
    hole = _ring(x + 10, y + 10, F.lit(40), F.lit(40), clockwise=True)
    second = F.array(_ring(x + 5000, y, w, h))
    first = F.when(i % 3 == 0, F.array(outer, hole)).otherwise(F.array(outer))
    coordinates = F.when(i % 5 == 0, F.array(first, second)).otherwise(F.array(first))
    return table(spark, sf_dir, "part").select(
        i.alias("i"),
        "p_name",
        "p_type",
        "p_retailprice",
        F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates")).alias("the_geom"),
    )


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw zone text per part, with the flaws the zone rules look for, and its geometry."""
    rows = parcels(spark, sf_dir)
    i = F.col("i")
    text = i.cast("string")
    return rows.select(
        "i",
        F.when(i % 19 == 0, F.concat(text, F.lit(" "), text)).otherwise(text).alias("objectid"),
        text.alias("location_id"),
        F.when(i % 7 == 0, F.concat("p_name", F.lit(" 40"))).otherwise(F.col("p_name")).alias("zone"),
        F.col("p_type").alias("borough"),
        F.when(i % 11 == 0, "1.5").when(i % 13 == 0, "0.1 0.2").when(i % 17 == 0, "")
        .otherwise(F.concat(F.lit("0."), (i % 97 + 1).cast("string"))).alias("shape_leng"),
        F.when(i % 23 == 0, "2").otherwise(F.concat(F.lit("0."), (i % 89 + 1).cast("string"))).alias("shape_area"),
        "the_geom",
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a fixed linear rule per chunk of 64 orders."""
    rows = kms(spark, sf_dir).select(
        (F.floor(F.col("l_orderkey") / 64) + 1).alias("chunk_id"),
        "trip_duration",
        (F.col("trip_distance") * 2 + 5).alias("prediction"),
    )
    found = stats.regression_metrics(rows, "trip_duration", "prediction", ("chunk_id",))
    return found.select("chunk_id", *[F.round(m, 6).alias(m) for m in ("rmse", "r2", "mae")])


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 500 events; neighbours are swapped so that some arrive late."""
    page = F.floor(F.col("event_id") / 500)
    swapped = F.when(page % 4 == 1, page + 1).when(page % 4 == 2, page - 1).otherwise(page)
    return table(spark, sf_dir, "events").withColumn("page_id", swapped)


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing entries of many sources: one per order, its customer is the source."""
    rows = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")

    def folder(d: Column) -> Column:
        return F.date_format(d, "yyyyMMdd")

    pending = F.when(key % 7 != 0, folder(F.date_sub(day, (key % 3).cast("int"))))
    return rows.select(
        F.col("o_custkey").alias("source_id"),
        key.alias("seq"),
        folder(day).alias("latest_lnd_folder"),
        pending.alias("latest_unprocessed_folder"),
        F.when(F.col("o_orderstatus") == "F", "processed").otherwise("unprocessed").alias("status"),
        folder(F.date_add(day, (key % 5).cast("int"))).alias("execution_dt"),
    )


def request_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message per order: requests of several shapes, greetings and thanks."""
    rows = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def text(c: Column) -> Column:
        return c.cast("string")

    pickup = (
        F.when(customer % 4 == 0, "Lantern Museum")
        .when(customer % 4 == 1, F.concat(F.lit("Pier "), text(customer % 90), F.lit(", Quay Side")))
        .when(customer % 4 == 2, F.concat(F.lit("Harbour Depot, Row "), text(customer), F.lit(", East")))
        .otherwise(F.concat(F.lit("Market "), text(customer)))
    )
    target = (
        F.when(key % 3 == 0, "Glass House, Long Meadow")
        .when(key % 3 == 1, F.concat(F.lit("Gate "), text(key % 50)))
        .otherwise("Union Square")
    )
    written = F.concat(text(key % 12 + 1), F.lit("/"), text(key % 28 + 1))
    day = (
        F.when(key % 6 == 0, "today").when(key % 6 == 1, "tomorrow").when(key % 6 == 2, "Friday")
        .when(key % 6 == 3, "monday").when(key % 6 == 4, written).otherwise("Sunday")
    )
    clock = F.format_string("%02d:%02d", (key * 7) % 24, (key * 13) % 60)
    kind = (key * 7) % 12
    asked = F.concat(F.lit("I would like to go from "), pickup, F.lit(" to "), target)
    whole = F.concat(asked, F.lit(" for "), day, F.lit(" at "), clock)
    short = F.concat(F.lit("from "), pickup, F.lit(" to "), target, F.lit(" for "), day, F.lit(" at 9:00"))
    message = (
        F.when(kind == 0, "Thank you!! See you")
        .when(kind == 1, F.concat(F.lit("Hello there, "), pickup))
        .when(kind == 2, F.upper(whole))
        .when(kind == 3, asked)
        .when(kind == 4, short)
        .otherwise(whole)
    )
    return rows.select(key.alias("conv_id"), (key % 4).alias("turn"), message.alias("text"))


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark, sf_dir).withColumn("rule", cleaning.first_failed_rule(AS_OF.year))
