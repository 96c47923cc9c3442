from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelight.operators import cleaning, projection
from farelight.plans.processing import measured_trips

BASE = dict(
    batch_id="a", tpep_pickup_datetime=datetime(2021, 3, 1, 8), minutes=20.0, trip_distance=5.0, pulocationid="1", dolocationid="2",
    fare_amount=10.0, extra=0.5, mta_tax=0.5, tolls_amount=0.0, improvement_surcharge=0.3,
)
SCHEMA = (
    "name string, batch_id string, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double, "
    "pulocationid string, dolocationid string, fare_amount double, extra double, mta_tax double, tolls_amount double, "
    "improvement_surcharge double"
)


def trips(spark, *cases):
    rows = []
    for name, changes in cases:
        row = {**BASE, **changes}
        minutes = row.pop("minutes")
        dropoff = row.get("tpep_dropoff_datetime", row["tpep_pickup_datetime"] + timedelta(minutes=minutes))
        rows.append((name, row["batch_id"], row["tpep_pickup_datetime"], dropoff, *[row[c] for c in (
            "trip_distance", "pulocationid", "dolocationid", "fare_amount", "extra", "mta_tax", "tolls_amount", "improvement_surcharge")]))
    return spark.createDataFrame(rows, SCHEMA)


def rules(spark, *cases):
    found = measured_trips(trips(spark, *cases), []).withColumn("rule", cleaning.first_failed_rule(2024))
    return {r["name"]: r["rule"] for r in found.collect()}


def test_minimum_duration_is_one_minute(spark):
    cases = [(f"{s}s", {"tpep_dropoff_datetime": BASE["tpep_pickup_datetime"] + timedelta(seconds=s)}) for s in (59.4, 60, 60.6)]
    kept = projection.trip_duration(trips(spark, *cases)).collect()
    assert {r["name"]: r["trip_duration"] for r in kept} == {"60s": 1.0, "60.6s": 1.01}


def test_every_rule_rejects_its_rows(spark):
    def year(y):
        return {"tpep_pickup_datetime": datetime(y, 3, 1, 8)}

    got = rules(
        spark,
        ("ok", {}), ("y1969", year(1969)), ("y1970", year(1970)), ("y1971", year(1971)), ("y2024", year(2024)), ("y2025", year(2025)),
        ("dropoff", {"tpep_pickup_datetime": datetime(2024, 12, 31, 23, 50)}),
        ("fare-1", {"fare_amount": -1.0}), ("fare0", {"fare_amount": 0.0}), ("fare.01", {"fare_amount": 0.01}),
        ("tolls", {"tolls_amount": -0.5}), ("extra", {"extra": -0.5}), ("extra0", {"extra": 0.0}), ("mta", {"mta_tax": -0.5}),
        ("surcharge", {"improvement_surcharge": -0.3}), ("distance", {"trip_distance": -2.0}),
        ("null fare", {"fare_amount": None}), ("fast", {"minutes": 1.0, "trip_distance": 30.0}),
        ("slow", {"minutes": 600.0, "trip_distance": 1.0}),
    )
    assert got == {
        "ok": 0, "y1969": 1, "y1970": 1, "y1971": 0, "y2024": 0, "y2025": 1, "dropoff": 2, "fare-1": 3, "fare0": 3, "fare.01": 0,
        "tolls": 4, "extra": 5, "extra0": 0, "mta": 6, "surcharge": 7, "distance": 8, "null fare": 3, "fast": 10, "slow": 10,
    }


def test_pickup_at_or_after_dropoff(spark):
    late = {"tpep_dropoff_datetime": BASE["tpep_pickup_datetime"]}
    early = {"tpep_dropoff_datetime": BASE["tpep_pickup_datetime"] - timedelta(minutes=5)}
    kept = cleaning.nonpositive_duration(trips(spark, ("equal", late), ("after", early), ("ok", {})))
    assert [r["name"] for r in kept.collect()] == ["ok"]


@pytest.mark.parametrize("speed,kept", [(1.0, 0), (1.01, 1), (199.99, 1), (200.0, 0)])
def test_speed_band_is_open(spark, speed, kept):
    rows = spark.createDataFrame([(speed,)], "average_speed double")
    assert cleaning.speed_band(rows).count() == kept


def test_zero_distance_takes_the_mean_of_its_batch(spark):
    rows = spark.createDataFrame(
        [("a", 0.0), ("a", 2.0), ("a", 4.0), ("b", 0.0), ("b", 10.0), ("c", 0.0), ("c", 0.0), ("a", None)], "batch_id string, trip_distance double"
    )
    got = sorted(tuple(r) for r in cleaning.zero_distance_impute(rows).fillna(-1.0).collect())
    assert got == [("a", -1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 10.0), ("b", 10.0), ("c", -1.0), ("c", -1.0)]


def test_zero_distance_of_many_batches_without_broadcast(spark, monkeypatch):
    rows = spark.range(1000).select((F.col("id") % 50).alias("batch_id"), (F.col("id") % 3).cast("double").alias("trip_distance"))
    expected = sorted(tuple(r) for r in cleaning.zero_distance_impute(rows).collect())
    import farelight.session as session

    monkeypatch.setattr(cleaning, "broadcast_if_small", lambda df: session.broadcast_if_small(df, 10))
    assert sorted(tuple(r) for r in cleaning.zero_distance_impute(rows).collect()) == expected


def test_audit_accounts_for_every_row(spark):
    rows = measured_trips(trips(spark, ("ok", {}), ("bad", {"fare_amount": 0.0}), ("worse", {"extra": -1.0, "fare_amount": 0.0})), [])
    audit = {r["rule_name"]: r["n_rows"] for r in cleaning.reject_audit(rows, 2024).collect()}
    assert audit == {"kept": 1, "fare_amount": 2}
    assert cleaning.apply_rules(rows, 2024).count() == 1


def test_null_report(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "a int, b int")
    assert {tuple(r) for r in cleaning.null_report(rows).collect()} == {("a", 2), ("b", 0)}
    assert [tuple(r) for r in cleaning.null_report(rows, only_nulls=True).collect()] == [("a", 2)]


def test_both_trip_types_are_required(spark):
    rows = spark.createDataFrame([("short_trip",)], "trip_type string")
    with pytest.raises(Exception, match="empty trip type"):
        cleaning.assert_non_empty(rows).collect()


def test_rules_reach_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    trips(spark, ("ok", {})).write.parquet(path)
    ruled = cleaning.apply_rules(spark.read.parquet(path).withColumn("average_speed", F.lit(20.0)), 2024)
    ruled.explain("formatted")
    plan = capsys.readouterr().out
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert "GreaterThan(fare_amount,0.0)" in pushed and "GreaterThanOrEqual(extra,0.0)" in pushed
    assert "year(" not in plan


def test_typed_projection_modes(spark):
    raw = spark.createDataFrame([("2021-03-01T07:57:46.000", "2.10"), ("soon", "2.10")], "tpep_pickup_datetime string, trip_distance string")
    types = {"tpep_pickup_datetime": "datetime", "trip_distance": "double"}
    with pytest.raises(Exception):
        projection.typed_projection(raw, types).collect()
    lenient = projection.typed_projection(raw, types, strict=False).collect()
    assert lenient[0][0] == datetime(2021, 3, 1, 7, 57, 46) and lenient[1][0] is None
    bad = projection.quarantine(raw, types).collect()
    assert [tuple(r) for r in bad] == [("soon", "2.10")]


def test_one_hot_columns(spark):
    rows = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "i int, c string")
    got = projection.one_hot_columns(rows, "c").orderBy("i").collect()
    assert [r.asDict() for r in got] == [
        {"i": 1, "c_null": 0, "c_a": 0, "c_b": 1}, {"i": 2, "c_null": 0, "c_a": 1, "c_b": 0}, {"i": 3, "c_null": 1, "c_a": 0, "c_b": 0},
    ]
    with pytest.raises(ValueError):
        projection.one_hot_columns(spark.range(20), "id", max_levels=10)
