"""The jobs, one after the other, on a few landing files."""

import json
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from farelight.operators import incremental
from farelight.plans import advisor, collection, enrichment, processing, training, zones
from farelight.sources import landing, sinks


def raw_trips(n, seed):
    rows = []
    for i in range(n):
        pickup = datetime(2021, 1 + i % 3, 1 + (i * 7 + seed) % 28, (i * 5) % 24, (i * 11) % 60)
        minutes = 8 + (i * 13) % 50
        miles = 30.0 if i % 10 == 0 else 0.0 if i % 17 == 0 else 1 + (i % 30) / 3
        row = {
            "tpep_pickup_datetime": pickup.strftime("%Y-%m-%dT%H:%M:%S.000"),
            "tpep_dropoff_datetime": (pickup + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S.000"),
            "trip_distance": str(miles), "pulocationid": str(1 + (i + seed) % 4), "dolocationid": str(1 + (i * 3) % 4),
            "fare_amount": str(5 + minutes * 0.5) if i % 23 else "-1", "extra": "0.5", "mta_tax": "0.5", "tolls_amount": "0",
            "improvement_surcharge": "0.3",
        }
        row.update({f"unused_{j}": "0" for j in range(8)})
        rows.append(row)
    return rows


def zone_rows():
    rows = []
    for i in range(1, 4):
        x, y = -74 + 0.1 * i, 40 + 0.1 * i
        ring = [[x, y], [x + 0.05, y], [x + 0.05, y + 0.05], [x, y + 0.05], [x, y]]
        rows.append({"objectid": str(i), "location_id": str(i), "zone": "Zone " + "abc"[i - 1], "borough": "Queens", "shape_leng": "0.1",
                     "shape_area": "0.02", "the_geom": {"type": "MultiPolygon", "coordinates": [[ring]]}})
    return rows


def test_from_landing_to_answers(spark, tmp_path):
    p = {name: str(tmp_path / name) for name in ("landing", "clean", "status", "zones", "enriched", "models")}
    (tmp_path / "landing" / "20240417").mkdir(parents=True)
    for seed in range(2):
        with open(tmp_path / "landing" / "20240417" / f"trips_{seed}.json", "w") as f:
            json.dump(raw_trips(400, seed), f, indent=4)
    today = date(2024, 5, 5)
    audit = processing.run(spark, p["landing"], p["clean"], p["status"], today, multi_line=True)
    counts = {r["rule_name"]: r["n"] for r in audit.groupBy("rule_name").agg(F.sum("n_rows").alias("n")).collect()}
    assert sum(counts.values()) == 800 and counts["fare_amount"] == 36
    assert processing.run(spark, p["landing"], p["clean"], p["status"], today) is None
    trips = spark.read.parquet(f"{p['clean']}/20240505")
    assert trips.count() == counts["kept"]
    assert {r[0] for r in trips.select("trip_type").distinct().collect()} == {"short_trip", "long_trip"}

    raw = tmp_path / "zones_raw.json"
    raw.write_text(json.dumps(zone_rows()))
    assert zones.run(spark, str(raw), p["zones"]).count() == 0

    appended = enrichment.run(spark, f"{p['clean']}/20240505", p["zones"], p["enriched"])
    without_zone = trips.filter("pulocationid = '4' OR dolocationid = '4'").count()
    assert appended == trips.count() - without_zone
    assert enrichment.run(spark, f"{p['clean']}/20240505", p["zones"], p["enriched"]) == 0

    root = f"{p['models']}/20240613"
    for target in ("duration", "cost"):
        training.run(spark, p["enriched"], target, "short_trip", "linear_regressor", root, chunk_size=200, train_fraction=0.6)
    texts = spark.createDataFrame(
        [(1, 0, "I would like to go from A to B for tomorrow at 10:00", 5.0, 2.0), (2, 0, "hello", 5.0, 2.0),
         (3, 1, "go from A, x to B for 12/24 at 23:30", 12.0, 9.0), (4, 1, "go from A to B for today at 9:00", 5.0, 2.0)],
        "conv_id int, turn int, text string, trip_distance double, haversine_centroid_distance double",
    )
    far = spark.createDataFrame([(5, 1, "go from A to B for today at 09:00", 60.0, 50.0)], texts.schema)
    answers = advisor.run(spark, texts.union(far), p["models"], today).orderBy("conv_id").collect()
    assert [(r["conv_id"], r["score_status"]) for r in answers] == [(1, "ok"), (3, "ok"), (5, "no_model")]
    assert answers.pop()["trip_duration"] is None
    assert answers[1]["pickup_ts"] == datetime(2024, 12, 24, 23, 30) and answers[0]["pickup_place"] == "A"
    for r in answers:
        assert r["trip_duration"] > 0 and r["answer"].startswith("🚕 Your trip")
        assert r["dropoff_ts"] == r["pickup_ts"] + timedelta(minutes=r["trip_duration"])


def collect_rows(spark, tmp_path, rows, threshold="2021-02-28", day=date(2024, 4, 17)):
    p = {name: str(tmp_path / name) for name in ("drops", "landing", "marks", "cp")}
    sinks.ndjson_sink(rows, p["drops"], "append")
    collection.run(spark, threshold, p["drops"], p["landing"], p["marks"], p["cp"], day)
    return p


def test_collection(spark, tmp_path):
    rows = spark.createDataFrame(raw_trips(50, 0)).select(*landing.LANDING_COLUMNS)
    p = collect_rows(spark, tmp_path, rows)
    got = landing.landing_scan(spark, f"{p['landing']}/20240417", multi_line=False)
    expected = rows.filter("tpep_pickup_datetime <= '2021-02-28T00:00:00.000'").count()
    assert got.count() == expected
    assert spark.read.json(p["marks"]).select("execution_date").first()[0] == "20240417"


def test_collection_with_a_later_threshold(spark, tmp_path):
    """One file that a threshold cuts through: the next run collects the rest of it."""
    wanted = ["2021-01-10T00:00:00.000", "2021-03-05T00:00:00.000"]
    rows = spark.createDataFrame(raw_trips(2, 0)[:2]).select(*landing.LANDING_COLUMNS)
    times = spark.createDataFrame([(t,) for t in wanted], "tpep_pickup_datetime string")
    rows = rows.limit(1).drop("tpep_pickup_datetime").crossJoin(times).select(*landing.LANDING_COLUMNS).coalesce(1)
    p = collect_rows(spark, tmp_path, rows)

    def stored():
        found = [landing.landing_scan(spark, f"{p['landing']}/{d.name}", multi_line=False) for d in (tmp_path / "landing").iterdir()]
        return sorted(r["tpep_pickup_datetime"] for f in found for r in f.collect())

    assert stored() == wanted[:1]
    for day in (18, 19):
        collection.run(spark, "2021-04-30", p["drops"], p["landing"], p["marks"], p["cp"], date(2024, 4, day))
        assert stored() == wanted
    assert incremental.high_water_mark(spark.read.json(p["marks"])).first()["mark"] == datetime(2021, 3, 5)


def test_from_collection_to_answers(spark, tmp_path):
    rows = spark.createDataFrame(raw_trips(600, 1)).select(*landing.LANDING_COLUMNS)
    p = collect_rows(spark, tmp_path, rows, "2022-01-01")
    p |= {name: str(tmp_path / name) for name in ("clean", "status", "zones", "enriched", "models")}
    today = date(2024, 5, 5)
    audit = processing.run(spark, p["landing"], p["clean"], p["status"], today)
    assert audit.agg(F.sum("n_rows")).first()[0] == 600
    raw = tmp_path / "zones_raw.json"
    raw.write_text(json.dumps(zone_rows()))
    zones.run(spark, str(raw), p["zones"])
    trips = spark.read.parquet(f"{p['clean']}/20240505")
    with_zone = trips.filter("pulocationid <> '4' AND dolocationid <> '4'").count()
    assert enrichment.run(spark, f"{p['clean']}/20240505", p["zones"], p["enriched"]) == with_zone > 0
    for target in ("duration", "cost"):
        training.run(
            spark, p["enriched"], target, "short_trip", "voting_regressor", p["models"], chunk_size=40, train_fraction=0.6, tuning=True
        )
        assert spark.read.json(f"{p['models']}/{target}/short_trip/metadata/voting_regressor_tuning").filter("kept").count() == 1
    texts = spark.createDataFrame(
        [(1, 1, "go from A to B for today at 09:00", -73.98, 40.75, -73.95, 40.78)],
        "conv_id int, turn int, text string, pickup_lon double, pickup_lat double, dropoff_lon double, dropoff_lat double",
    )
    answer = advisor.run(spark, texts, p["models"], today).first()
    assert answer["score_status"] == "ok" and 3 < answer["trip_distance"] < 6 and answer["answer"].startswith("🚕 Your trip")


def test_enrichment_after_an_empty_first_run(spark, tmp_path):
    (tmp_path / "landing" / "20240417").mkdir(parents=True)
    with open(tmp_path / "landing" / "20240417" / "trips.json", "w") as f:
        json.dump(raw_trips(300, 0), f)
    p = {name: str(tmp_path / name) for name in ("landing", "clean", "status", "enriched")}
    processing.run(spark, p["landing"], p["clean"], p["status"], date(2024, 5, 5), multi_line=True)
    trips = f"{p['clean']}/20240505"
    for name, found in (("none", [{**zone_rows()[0], "objectid": "900"}]), ("some", zone_rows())):
        (tmp_path / f"{name}.json").write_text(json.dumps(found))
        zones.run(spark, str(tmp_path / f"{name}.json"), str(tmp_path / name))
    assert enrichment.run(spark, trips, str(tmp_path / "none"), p["enriched"]) == 0
    assert enrichment.run(spark, trips, str(tmp_path / "some"), p["enriched"]) > 0
    assert enrichment.run(spark, trips, str(tmp_path / "some"), p["enriched"]) == 0
