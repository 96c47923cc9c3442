import pytest
from pyspark.sql import functions as F

from farelight.operators import enrich
from farelight.plans import enrichment
from farelight.sources import sinks
from farelight.sources.key_index import KeyIndex
from farelight.sources.zones import ZONE_SCHEMA

ZONES = [
    ("1", "1", "Astoria", "Queens", "x", 0.5, "POINT (-73.9 40.1)"),
    ("2", "2", "Harlem", "Manhattan", "x", 0.25, "POINT (-74.1 40.7)"),
]


def zone_frame(spark):
    return spark.createDataFrame(ZONES, ZONE_SCHEMA)


def trip_frame(spark, rows):
    return spark.createDataFrame(rows, "pulocationid string, dolocationid string, trip_type string, partition_dt string, hashing_key string")


ROWS = [
    ("1", "2", "short_trip", "202101", "k1"), ("1", "1", "short_trip", "202101", "k2"), ("264", "1", "short_trip", "202101", "k3"),
    ("1", "265", "short_trip", "202101", "k4"), ("2", "1", "long_trip", "202102", "k5"), ("2", "1", "long_trip", "202102", "k5"),
]


def test_both_ends_and_missing_zones(spark):
    got = {r["hashing_key"]: r for r in enrich.enrich_trips(trip_frame(spark, ROWS), zone_frame(spark)).collect()}
    assert set(got) == {"k1", "k2", "k5"}
    assert (got["k1"]["pu_zone"], got["k1"]["do_zone"]) == ("Astoria", "Harlem")
    assert got["k1"]["pickup_coordinates"] == ["-73.9", "40.1"]
    assert got["k2"]["haversine_centroid_distance"] == 0.0
    assert got["k1"]["haversine_centroid_distance"] == got["k5"]["haversine_centroid_distance"]


def test_zone_joins_run_as_broadcast_inner_joins(spark):
    plan = enrich.enrich_trips(trip_frame(spark, ROWS), zone_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "LeftOuter" not in plan and "CartesianProduct" not in plan


def test_large_dimension_is_not_broadcast(spark, monkeypatch):
    import farelight.session as session

    monkeypatch.setattr(enrich, "broadcast_if_small", lambda df: session.broadcast_if_small(df, 1))
    rows = enrich.enrich_trips(trip_frame(spark, ROWS), zone_frame(spark))
    assert "rightHint=(strategy=broadcast)" not in rows._jdf.queryExecution().analyzed().toString()
    assert rows.count() == 4


def test_unseen_trips_keep_repeats(spark):
    new = trip_frame(spark, ROWS)
    existing = trip_frame(spark, [ROWS[0]])
    assert sorted(r["hashing_key"] for r in enrich.unseen_trips(new, existing).collect()) == ["k2", "k3", "k4", "k5", "k5"]
    assert sorted(r["hashing_key"] for r in enrich.drop_repeats(new).collect()) == ["k1", "k2", "k3", "k4", "k5"]


def test_keys_are_compared_within_type_and_month(spark):
    new = trip_frame(spark, ROWS[:1])
    elsewhere = trip_frame(spark, [("1", "2", "short_trip", "202102", "k1"), ("1", "2", "long_trip", "202101", "k1")])
    assert enrich.unseen_trips(new, elsewhere).count() == 1


def test_job_twice_appends_once(spark, tmp_path):
    trips, zones, output = (str(tmp_path / n) for n in ("trips", "zones", "out"))
    sinks.partitioned_append(trip_frame(spark, ROWS), trips)
    zone_frame(spark).write.json(zones)
    assert enrichment.run(spark, trips, zones, output) == 4
    assert enrichment.run(spark, trips, zones, output) == 0
    sinks.partitioned_append(trip_frame(spark, [("1", "2", "short_trip", "202101", "k9")]), trips)
    assert enrichment.run(spark, trips, zones, output, "short_trip") == 1
    months = spark.read.parquet(output).groupBy(F.col("partition_dt").cast("string")).count().collect()
    assert {tuple(r) for r in months} == {("202101", 3), ("202102", 2)}


def test_hot_key(spark):
    """A third of the rows are copies of one trip."""
    rows = spark.range(30000).select(
        F.lit("1").alias("pulocationid"), F.lit("2").alias("dolocationid"), F.lit("short_trip").alias("trip_type"),
        F.lit("202101").alias("partition_dt"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hashing_key"),
    )
    assert enrich.unseen_trips(rows, rows.filter("hashing_key = 'hot'").limit(1)).count() == 20000
    assert enrich.unseen_trips(rows, rows.filter("hashing_key = '1'")).count() == 29999


def test_hot_key_is_split_over_tasks(spark):
    """With sizes scaled down, adaptive execution splits the anti-join partition of a hot key."""
    scaled = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in scaled}
    try:
        for k, v in scaled.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hashing_key"),
            F.lit("202101").alias("partition_dt"), F.lit("short_trip").alias("trip_type"), F.md5(F.col("id").cast("string")).alias("payload"),
        )
        unseen = enrich.unseen_trips(rows, rows.filter("hashing_key LIKE '1%'"))
        assert unseen.count() > 20000
        collected = unseen.agg(F.count("payload").alias("n"))
        assert collected.first()["n"] == rows.filter("hashing_key NOT LIKE '1%'").count()
        collected.collect()
        plan = collected._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def key_frame(spark, names, month="202101"):
    return spark.createDataFrame([("short_trip", month, k) for k in names], "trip_type string, partition_dt string, hashing_key string")


def test_key_index(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=4)
    assert index.is_empty() and index.append_unseen(key_frame(spark, ["a", "a", "b"]), 1) == (2, 2)
    # Another session or a later one opens the same files; the number of buckets is that of the files.
    index = KeyIndex(spark, str(tmp_path / "keys"))
    assert index.buckets == 4
    assert index.append_unseen(key_frame(spark, ["b", "c"]), 2) == (2, 1)
    assert index.append_unseen(key_frame(spark, ["b", "c", "d"]), 2) == (3, 2)
    assert [r["hashing_key"] for r in index.seen(key_frame(spark, ["b", "c"]), 2).collect()] == ["b"]
    assert index.append_unseen(key_frame(spark, ["b"], "202102"), 3) == (1, 1)
    assert index.append_unseen(key_frame(spark, []), 4) == (0, 0)
    everything = sorted((r["partition_dt"], r["hashing_key"]) for r in index.table().collect())
    assert everything == [("202101", k) for k in "abcd"] + [("202102", "b")]
    index.compact()
    assert sorted((r["partition_dt"], r["hashing_key"]) for r in KeyIndex(spark, str(tmp_path / "keys")).table().collect()) == everything
    assert len(list((tmp_path / "keys" / "rows").iterdir())) == 1


def test_stored_keys_are_neither_shuffled_nor_rewritten(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=8)
    index.append_unseen(key_frame(spark, [str(i) for i in range(500)]), 1)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "keys" / "rows").rglob("*.parquet")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = key_frame(spark, [str(i) for i in range(400, 900)])
        plan = index.seen(new, 2)._jdf.queryExecution().executedPlan().toString()
        stored = plan[plan.index("FileScan") - 600 :]
        assert "Bucketed: true" in stored and "In(partition_dt" in stored.replace("EqualTo(partition_dt", "In(partition_dt")
        assert plan.count("Exchange") == plan[: plan.index("FileScan")].count("Exchange")
        assert index.append_unseen(new, 2) == (500, 400)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert before.items() <= {f: f.stat().st_mtime_ns for f in (tmp_path / "keys" / "rows").rglob("*.parquet")}.items()


def test_job_after_a_run_that_broke_off(spark, tmp_path, monkeypatch):
    trips, zones, output = (str(tmp_path / n) for n in ("trips", "zones", "out"))
    sinks.partitioned_append(trip_frame(spark, ROWS), trips)
    zone_frame(spark).write.json(zones)
    # Keys are stored, trips are not.
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(sinks, "partitioned_append", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        enrichment.run(spark, trips, zones, output)
    assert enrichment.run(spark, trips, zones, output) == 4
    # Trips are stored, the run is not closed.
    sinks.partitioned_append(trip_frame(spark, [("1", "2", "short_trip", "202101", "k9")]), trips)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(KeyIndex, "finish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        enrichment.run(spark, trips, zones, output)
    assert enrichment.run(spark, trips, zones, output) == 0
    # A target without an index gets one.
    assert enrichment.run(spark, trips, zones, output, keys_path=str(tmp_path / "other")) == 0
    assert spark.read.parquet(output).count() == 5


def test_indexed_enrichment_of_a_hot_key(spark, tmp_path):
    rows = spark.range(30000).select(
        F.lit("1").alias("pulocationid"), F.lit("2").alias("dolocationid"), F.lit("short_trip").alias("trip_type"),
        F.lit("202101").alias("partition_dt"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, None).otherwise(F.col("id").cast("string")).alias("hashing_key"),
    )
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=4)
    index.append_unseen(key_frame(spark, ["hot", "2"]), 1)
    assert enrich.indexed_enrich(rows, index, zone_frame(spark), 2).count() == 19999
    assert enrich.indexed_enrich(rows, index, zone_frame(spark), 3, dedupe_batch=True).collect()[0]["hashing_key"] is None


def test_seen_trips_are_left_out_before_zones_are_added(spark, tmp_path):
    """No column of a zone passes the shuffle of the join with seen keys."""
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=2)
    new = trip_frame(spark, ROWS)
    first = enrich.indexed_enrich(trip_frame(spark, ROWS[:1]), index, zone_frame(spark), 0)
    assert first.count() == 1
    rows = enrich.indexed_enrich(new, index, zone_frame(spark), 1)
    anti = next(part for part in rows._jdf.queryExecution().analyzed().toString().split("Join LeftAnti")[1:])
    assert "pu_zone" not in anti.split("Join LeftSemi")[0].replace(":- ", "")
    assert sorted(r["hashing_key"] for r in rows.collect()) == ["k2", "k5", "k5"]
