"""Query registry and the SQL building blocks shared by the equivalent statements."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from farelight.session import prepare, release_kept

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Queries whose results SQL cannot state, as they are values of models with all features; tests hold them against brute force.
FITTED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

AS_OF = date(2026, 12, 31)
HOLIDAY_YEARS = (1995, 2002)

# Named subqueries over the test tables, in dependency order.
CTES = {
    "trips": """
        SELECT l_orderkey * 10 + l_linenumber AS trip_id,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_key,
               l_orderkey, l_orderkey % 8 AS batch_id,
               pu AS tpep_pickup_datetime,
               pu + to_seconds((l_partkey * 37 + l_linenumber * 11) % 5400 - 30) AS tpep_dropoff_datetime,
               CASE WHEN l_partkey % 41 = 0 THEN 0.0::DOUBLE ELSE l_quantity * 0.6::DOUBLE END AS trip_distance,
               ((l_suppkey * 13 + l_linenumber) % 265 + 1)::VARCHAR AS pulocationid,
               (l_partkey % 265 + 1)::VARCHAR AS dolocationid,
               (CASE WHEN l_partkey % 97 = 0 THEN -1 ELSE 1 END)
                 * (floor(l_extendedprice / 1000) + 0.5::DOUBLE * (l_partkey % 2)) AS fare_amount,
               CASE WHEN l_partkey % 113 = 0 THEN -1.0::DOUBLE ELSE 0.5::DOUBLE * (l_linenumber % 3) END AS extra,
               CASE WHEN l_partkey % 127 = 0 THEN -0.5::DOUBLE ELSE 0.5::DOUBLE END AS mta_tax,
               CASE WHEN l_suppkey % 10 = 0 THEN 6.12::DOUBLE ELSE 0.0::DOUBLE END AS tolls_amount,
               0.3::DOUBLE AS improvement_surcharge
        FROM (SELECT *, l_shipdate + to_days((CASE WHEN l_orderkey % 499 = 0 THEN 40000 ELSE 0 END)::INTEGER)
                        + to_minutes((l_orderkey * 7 + l_partkey) % 1440) + to_seconds(l_suppkey % 60) AS pu
              FROM lineitem)""",
    "timed": """
        SELECT * FROM (
          SELECT *, round(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 6e7::DOUBLE, 2) AS trip_duration
          FROM trips)
        WHERE trip_duration >= 1.0""",
    "kms": "SELECT * REPLACE (round(trip_distance * 1.60934::DOUBLE, 2) AS trip_distance) FROM timed",
    "imputed": """
        SELECT k.* REPLACE (CASE WHEN k.trip_distance = 0 THEN m.mean_km ELSE k.trip_distance END AS trip_distance)
        FROM kms k LEFT JOIN (SELECT batch_id, avg(trip_distance) FILTER (trip_distance <> 0) AS mean_km
                              FROM kms GROUP BY batch_id) m USING (batch_id)""",
    "measured": """
        SELECT *, fare_amount + extra + mta_tax + tolls_amount + improvement_surcharge AS trip_cost,
               trip_distance / (trip_duration / 60)::FLOAT AS average_speed
        FROM imputed""",
    "ruled": """
        SELECT *, CASE
            WHEN NOT coalesce(year(tpep_pickup_datetime) > 1970 AND year(tpep_pickup_datetime) <= 2026, false) THEN 1
            WHEN NOT coalesce(year(tpep_dropoff_datetime) > 1970 AND year(tpep_dropoff_datetime) <= 2026, false) THEN 2
            WHEN NOT coalesce(fare_amount > 0, false) THEN 3
            WHEN NOT coalesce(tolls_amount >= 0, false) THEN 4
            WHEN NOT coalesce(extra >= 0, false) THEN 5
            WHEN NOT coalesce(mta_tax >= 0, false) THEN 6
            WHEN NOT coalesce(improvement_surcharge >= 0, false) THEN 7
            WHEN NOT coalesce(trip_distance > 0, false) THEN 8
            WHEN NOT coalesce(tpep_pickup_datetime < tpep_dropoff_datetime, false) THEN 9
            WHEN NOT coalesce(average_speed > 1 AND average_speed < 200, false) THEN 10
            ELSE 0 END AS rule
        FROM measured""",
    "clean": """
        SELECT * EXCLUDE (rule), strftime(tpep_pickup_datetime, '%Y%m') AS partition_dt,
               CASE WHEN trip_distance > 35.0 THEN 'long_trip' ELSE 'short_trip' END AS trip_type,
               md5(concat_ws('|', epoch_us(tpep_pickup_datetime), pulocationid, dolocationid,
                             round(trip_cost * 10000)::BIGINT)) AS hashing_key
        FROM ruled WHERE rule = 0""",
    "calendar": "SELECT r::DATE AS d FROM range(DATE '1995-01-01', DATE '2003-01-01', INTERVAL 1 DAY) t(r)",
    "fixed_days": """
        SELECT d FROM calendar WHERE (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4)
           OR (month(d) = 11 AND day(d) = 11) OR (month(d) = 12 AND day(d) = 25)""",
    "holidays": """
        SELECT d FROM (
          SELECT d FROM fixed_days
          UNION SELECT d - 1 FROM fixed_days WHERE isodow(d) = 6
          UNION SELECT d + 1 FROM fixed_days WHERE isodow(d) = 7
          UNION SELECT d FROM calendar WHERE isodow(d) = 1 AND (
                (month(d) IN (1, 2) AND day(d) BETWEEN 15 AND 21) OR (month(d) = 5 AND day(d) >= 25)
                OR (month(d) = 9 AND day(d) <= 7) OR (month(d) = 10 AND day(d) BETWEEN 8 AND 14))
          UNION SELECT d FROM calendar WHERE isodow(d) = 4 AND month(d) = 11 AND day(d) BETWEEN 22 AND 28)
        WHERE year(d) BETWEEN 1995 AND 2001""",
    "zones": """
        SELECT i::VARCHAR AS objectid, 'Zone ' || translate(i::VARCHAR, '0123456789', 'abcdefghij') AS zone,
               (100 + 5 * (i % 7)) * (100 + 5 * (i % 5)) / 1e8 AS polygon_area,
               (-742500 + 300 * (i % 20) + (100 + 5 * (i % 7)) / 2) / 1e4 AS lon,
               (405000 + 300 * (i // 20) + (100 + 5 * (i % 5)) / 2) / 1e4 AS lat
        FROM range(1, 264) t(i)""",
    "enriched": """
        SELECT c.*, p.zone AS pu_zone, p.polygon_area AS pu_polygon_area, p.lon AS pu_lon, p.lat AS pu_lat,
               q.zone AS do_zone, q.polygon_area AS do_polygon_area, q.lon AS do_lon, q.lat AS do_lat,
               2 * 6371.0087714150598 * asin(least(1.0, sqrt(
                 sin(radians(q.lat - p.lat) / 2) ** 2
                 + cos(radians(p.lat)) * cos(radians(q.lat)) * sin(radians(q.lon - p.lon) / 2) ** 2))) AS haversine_centroid_distance
        FROM clean c JOIN zones p ON c.pulocationid = p.objectid JOIN zones q ON c.dolocationid = q.objectid""",
    "features": """
        SELECT e.*, (CASE WHEN hour(tpep_pickup_datetime) BETWEEN 7 AND 10 OR hour(tpep_pickup_datetime) BETWEEN 16 AND 19 THEN 1
                        WHEN hour(tpep_pickup_datetime) >= 20 OR hour(tpep_pickup_datetime) <= 6 THEN 2 ELSE 3 END) AS pickup_daytime,
               hour(tpep_pickup_datetime) AS pickup_hour, isodow(tpep_pickup_datetime) AS pickup_weekday,
               (hour(tpep_pickup_datetime) * 60 + minute(tpep_pickup_datetime)) // 15 AS pickup_quarter,
               hour(tpep_pickup_datetime) * 60 + minute(tpep_pickup_datetime) AS pickup_seconds,
               (tpep_pickup_datetime::DATE IN (SELECT d FROM holidays))::INTEGER AS pickup_holiday,
               (isodow(tpep_pickup_datetime) >= 6)::INTEGER AS pickup_weekend,
               ('0x' || substr(md5(concat_ws('|', trip_key, '1234')), 1, 8))::BIGINT % 10000 < 2000 AS is_train,
               ('0x' || substr(md5(concat_ws('|', trip_key, '42')), 1, 8))::BIGINT % 10 AS fold
        FROM enriched e""",
    "parcels": """
        SELECT p_partkey AS i, p_name, p_type, p_retailprice,
               -742500 + 300 * (p_partkey % 20) AS x, 405000 + 300 * ((p_partkey // 20) % 20) AS y,
               100 + 5 * (p_partkey % 7) AS w, 100 + 5 * (p_partkey % 5) AS h,
               p_partkey % 3 = 0 AS has_hole, p_partkey % 5 = 0 AS has_second
        FROM part""",
    "raw_zones": """
        SELECT p_partkey AS i,
               CASE WHEN p_partkey % 19 = 0 THEN concat(p_partkey, ' ', p_partkey) ELSE p_partkey::VARCHAR END AS objectid,
               p_partkey::VARCHAR AS location_id,
               CASE WHEN p_partkey % 7 = 0 THEN p_name || ' 40' ELSE p_name END AS zone,
               p_type AS borough,
               CASE WHEN p_partkey % 11 = 0 THEN '1.5' WHEN p_partkey % 13 = 0 THEN '0.1 0.2' WHEN p_partkey % 17 = 0 THEN ''
                    ELSE '0.' || (p_partkey % 97 + 1)::VARCHAR END AS shape_leng,
               CASE WHEN p_partkey % 23 = 0 THEN '2' ELSE '0.' || (p_partkey % 89 + 1)::VARCHAR END AS shape_area
        FROM part""",
    "scores": """
        SELECT l_orderkey // 64 + 1 AS chunk_id, round(sqrt(avg(e * e)), 6) AS rmse,
               round(1 - avg(e * e) / var_pop(trip_duration), 6) AS r2, round(avg(abs(e)), 6) AS mae
        FROM (SELECT *, trip_duration - (trip_distance * 2 + 5) AS e FROM kms) GROUP BY 1""",
    "judged": """
        SELECT *, row_number() OVER w AS rn, min(rmse) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best,
               first(rmse) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_rmse
        FROM scores WINDOW w AS (ORDER BY chunk_id)""",
    "improvements": """
        SELECT *, best IS NULL OR rmse < best AS improved,
               CASE WHEN rmse < best THEN round((1 - rmse / first_rmse) * 100, 2) ELSE 0.0 END AS percentage_improvement
        FROM judged""",
    "pages": """
        SELECT CASE p % 4 WHEN 1 THEN p + 1 WHEN 2 THEN p - 1 ELSE p END AS page_id, max(ts) AS max_date
        FROM (SELECT event_id // 500 AS p, ts FROM events) GROUP BY 1""",
    "status_log": """
        SELECT o_custkey AS source_id, o_orderkey AS seq, strftime(o_orderdate, '%Y%m%d') AS latest_lnd_folder,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL
                    ELSE strftime(o_orderdate - to_days((o_orderkey % 3)::INTEGER), '%Y%m%d') END AS latest_unprocessed_folder,
               CASE WHEN o_orderstatus = 'F' THEN 'processed' ELSE 'unprocessed' END AS status,
               strftime(o_orderdate + to_days((o_orderkey % 5)::INTEGER), '%Y%m%d') AS execution_dt
        FROM orders""",
    "newest_status": """
        SELECT source_id, seq, last_seq, coalesce(status = 'unprocessed' AND latest_unprocessed_folder =
               CASE WHEN source_id % 3 = 0 THEN latest_unprocessed_folder ELSE '19000101' END, false) AS flip
        FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY execution_dt DESC, seq) AS rn,
                     max(seq) OVER (PARTITION BY source_id) AS last_seq FROM status_log) WHERE rn = 1""",
    "request_texts": """
        SELECT o_orderkey AS conv_id, o_orderkey % 4 AS turn, CASE
          WHEN k = 0 THEN 'Thank you!! See you'
          WHEN k = 1 THEN 'Hello there, ' || pu
          WHEN k = 2 THEN upper(concat('I would like to go from ', pu, ' to ', dest, ' for ', dy, ' at ', clock))
          WHEN k = 3 THEN concat('I would like to go from ', pu, ' to ', dest)
          WHEN k = 4 THEN concat('from ', pu, ' to ', dest, ' for ', dy, ' at 9:00')
          ELSE concat('I would like to go from ', pu, ' to ', dest, ' for ', dy, ' at ', clock) END AS text
        FROM (SELECT *, (o_orderkey * 7) % 12 AS k,
                CASE o_custkey % 4 WHEN 0 THEN 'Lantern Museum' WHEN 1 THEN 'Pier ' || (o_custkey % 90)::VARCHAR || ', Quay Side'
                     WHEN 2 THEN 'Harbour Depot, Row ' || o_custkey::VARCHAR || ', East' ELSE 'Market ' || o_custkey::VARCHAR END AS pu,
                CASE o_orderkey % 3 WHEN 0 THEN 'Glass House, Long Meadow' WHEN 1 THEN 'Gate ' || (o_orderkey % 50)::VARCHAR
                     ELSE 'Union Square' END AS dest,
                CASE o_orderkey % 6 WHEN 0 THEN 'today' WHEN 1 THEN 'tomorrow' WHEN 2 THEN 'Friday' WHEN 3 THEN 'monday'
                     WHEN 4 THEN (o_orderkey % 12 + 1)::VARCHAR || '/' || (o_orderkey % 28 + 1)::VARCHAR ELSE 'Sunday' END AS dy,
                lpad(((o_orderkey * 7) % 24)::VARCHAR, 2, '0') || ':' || lpad(((o_orderkey * 13) % 60)::VARCHAR, 2, '0') AS clock
              FROM orders)""",
}

# What each subquery reads.
NEEDS = {
    "timed": ["trips"], "kms": ["timed"], "imputed": ["kms"], "measured": ["imputed"], "ruled": ["measured"],
    "clean": ["ruled"], "fixed_days": ["calendar"], "holidays": ["fixed_days"], "enriched": ["clean", "zones"], "features": ["enriched", "holidays"],
    "scores": ["kms"], "newest_status": ["status_log"], "judged": ["scores"], "improvements": ["judged"],
}


def statement(body: str, *names: str) -> str:
    """``body`` preceded by the named subqueries and everything they read."""
    wanted: set[str] = set()
    pending = list(names)
    while pending:
        name = pending.pop()
        if name not in wanted:
            wanted.add(name)
            pending += NEEDS.get(name, [])
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in wanted]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def query(name: str, sql: str | None = None, reads: tuple[str, ...] = ()):
    """Register a Spark query and, when there is one, its SQL statement."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # What earlier queries kept is not needed any more; a frame still in use is evaluated again.
            release_kept()
            return function(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = statement(sql, *reads)
        return function

    return register


def fitted_query(name: str):
    """Register a Spark query that has no SQL."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            release_kept()
            return function(prepare(spark), sf_dir)

        FITTED[name] = run
        return function

    return register
