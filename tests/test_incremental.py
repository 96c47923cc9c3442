from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelight.operators import incremental
from farelight.plans import processing
from farelight.sources import checkpoints
from farelight.streaming import dedup, ingest

STATUS = "seq bigint, latest_lnd_folder string, latest_unprocessed_folder string, status string, execution_dt string"


def test_mark_of_nothing_is_1970(spark, tmp_path):
    nothing = checkpoints.checkpoint_scan(spark, str(tmp_path / "none"))
    assert incremental.high_water_mark(nothing).first()["mark"] == datetime(1970, 1, 1)


def test_mark_is_the_greatest_row(spark):
    rows = spark.createDataFrame([("2011-02-01T00:00:01", "20240417"), ("2011-01-31T23:59:59", "20240418")], checkpoints.INGEST_SCHEMA)
    assert incremental.high_water_mark(rows).first()["mark"] == datetime(2011, 2, 1, 0, 0, 1)


def test_extract_bounds(spark):
    rows = spark.createDataFrame([(datetime(2021, 1, d),) for d in (1, 2, 3, 4)], "ts timestamp_ntz")
    got = incremental.incremental_extract(rows, "ts", datetime(2021, 1, 1), datetime(2021, 1, 3)).collect()
    assert [r["ts"].day for r in got] == [2, 3]


def gate(spark, entries, landing_day):
    status = incremental.latest_status(spark.createDataFrame(entries, STATUS))
    row = incremental.processing_gate(status.withColumn("landing_day", F.lit(landing_day))).first()
    return row["run"], row["reason"]


def test_gate(spark):
    done = (0, "20240417", "20240417", "processed", "20240505")
    open_ = (0, "20240417", "20240417", "unprocessed", "20240505")
    assert gate(spark, [], date(2024, 4, 17)) == (True, "new_folder")
    assert gate(spark, [done], date(2024, 4, 18)) == (True, "new_folder")
    assert gate(spark, [done], date(2024, 4, 17)) == (False, "already_processed")
    assert gate(spark, [open_], date(2024, 4, 17)) == (True, "unprocessed_folder")
    assert gate(spark, [(0, "20240417", None, None, "20240505")], date(2024, 4, 17)) == (False, "no_unprocessed_folder")


def upsert(spark, history, run):
    runs = spark.createDataFrame([run], "folder string, " + checkpoints.STATUS_SCHEMA)
    return sorted(tuple(r) for r in incremental.status_upsert(spark.createDataFrame(history, STATUS), runs).collect())


def test_upsert(spark):
    first = (0, "20240417", "20240417", "unprocessed", "20240505")
    entry = ("20240418", "20240418", "unprocessed", "20240506")
    assert upsert(spark, [], ("", *entry)) == [(0, *entry)]
    assert upsert(spark, [first], ("20240417", None, None, None, None)) == [(0, "20240417", "20240417", "processed", "20240505")]
    assert upsert(spark, [first], ("20240416", None, None, None, None)) == [first]
    assert upsert(spark, [first], ("", *entry)) == [first, (1, *entry)]


@pytest.mark.parametrize("text,check", [
    ("2024-05-01", "ok"), ("2025-01-01", "invalid_year"), ("2024-13-01", "invalid_month"), ("2024-01-32", "invalid_day"),
    ("2024-01-00", "invalid_day"), ("2024-02-30", "invalid_date"), ("soon", "invalid_date"), ("2024-5-1", "ok"),
])
def test_threshold_text(spark, text, check):
    row = incremental.date_string_validation(spark.createDataFrame([(text,)], "d string"), "d", 2024).first()
    assert row["check"] == check
    assert row["threshold"] == ("2024-05-01T00:00:00" if check == "ok" else None)


def test_two_drops_equal_one_batch(spark, tmp_path):
    drops, rows, marks, checkpoint = (str(tmp_path / n) for n in ("drops", "rows", "marks", "cp"))
    schema = "id int, ts timestamp_ntz"
    first = spark.createDataFrame([(i, datetime(2021, 1, 1 + i)) for i in range(10)], schema)
    second = spark.createDataFrame([(i, datetime(2021, 1, 1 + i)) for i in range(5, 20)], schema)
    until = datetime(2021, 1, 18)

    def run(start):
        stream = ingest.landing_stream(spark, drops, schema, 1, "parquet")
        ingest.incremental_ingest(stream, "ts", rows, marks, checkpoint, until, "20240417", start)

    first.coalesce(1).write.parquet(f"{drops}", mode="append")
    run(None)
    assert ingest.stored_mark(spark, marks) == datetime(2021, 1, 10)
    second.coalesce(1).write.parquet(f"{drops}", mode="append")
    run(None)
    assert ingest.stored_mark(spark, marks) == datetime(2021, 1, 18)
    got = sorted(r["id"] for r in spark.read.schema(schema).parquet(rows).collect())
    # Late rows of the second drop (ids 5..9) lie at or below the mark and are not taken again.
    assert got == list(range(18))
    run(None)
    assert spark.read.parquet(rows).count() == 18


DAYS = "id int, ts timestamp_ntz"


def ingested(spark, tmp_path, drops, threshold, start=None):
    """One run after dropping a file with a row for each day of 2021; the ids stored so far."""
    p = {n: str(tmp_path / n) for n in ("drops", "rows", "marks", "cp")}
    if drops:
        rows = [(i, datetime(2021, 1, 1) + timedelta(days=i)) for i in drops]
        spark.createDataFrame(rows, DAYS).coalesce(1).write.parquet(p["drops"], mode="append")
    stream = ingest.landing_stream(spark, p["drops"], DAYS, 1, "parquet")
    until = datetime(2021, 1, 1) + timedelta(days=threshold)
    ingest.incremental_ingest(stream, "ts", p["rows"], p["marks"], p["cp"], until, "20240417", start)
    return sorted(r["id"] for r in spark.read.schema(DAYS).parquet(p["rows"]).collect())


def test_later_thresholds_take_what_was_left(spark, tmp_path):
    assert ingested(spark, tmp_path, range(0, 100), 30) == list(range(31))
    # Another file, days 20 to 119; those up to the mark are late.
    assert ingested(spark, tmp_path, range(20, 120), 50) == sorted([*range(51), *range(31, 51)])
    assert ingest.stored_mark(spark, str(tmp_path / "marks")) == datetime(2021, 2, 20)
    # A lower threshold takes nothing, a higher one all that is left, and a repeated one nothing again.
    assert len(ingested(spark, tmp_path, (), 40)) == 71
    assert ingested(spark, tmp_path, (), 365) == sorted([*range(51), *range(31, 51), *range(51, 100), *range(51, 120)])
    assert len(ingested(spark, tmp_path, (), 365)) == 189
    assert ingest.stored_mark(spark, str(tmp_path / "marks")) == datetime(2021, 4, 30)


@pytest.mark.parametrize("second", [30, 20, 60])
def test_a_run_that_breaks_off_is_continued(spark, tmp_path, monkeypatch, second):
    assert ingested(spark, tmp_path, range(0, 80), 10) == list(range(11))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(ingest.DeferredRows, "close_run", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        ingested(spark, tmp_path, range(40, 90), 30)
    ingested(spark, tmp_path, (), second)
    assert ingested(spark, tmp_path, (), 365) == sorted([*range(80), *range(40, 90)])


@pytest.mark.parametrize("second", [30, 20, 60])
def test_a_batch_tried_again_with_another_threshold(spark, tmp_path, monkeypatch, second):
    with monkeypatch.context() as m, pytest.raises(Exception):
        m.setattr(ingest, "checkpoint_rows", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        ingested(spark, tmp_path, range(0, 80), 30)
    ingested(spark, tmp_path, (), second)
    assert ingested(spark, tmp_path, (), 365) == list(range(80))


def test_stream_dedup(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(f"k{i % 7}", datetime(2021, 1, 1, i % 24)) for i in range(50)]
    spark.createDataFrame(rows, "hashing_key string, ts timestamp").write.parquet(src)
    stream = spark.readStream.schema("hashing_key string, ts timestamp").parquet(src)
    dedup.run_to_parquet(dedup.dedup_on_key(stream, "ts"), out, str(tmp_path / "cp"))
    assert sorted(r["hashing_key"] for r in spark.read.parquet(out).collect()) == [f"k{i}" for i in range(7)]


def test_stream_enrichment_suppresses_stored_keys(spark, tmp_path):
    from test_enrich import ROWS, trip_frame, zone_frame

    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part in (ROWS[:2], ROWS):
        trip_frame(spark, part).write.mode("append").parquet(src)
        stream = spark.readStream.schema(trip_frame(spark, ROWS).schema).parquet(src)
        dedup.enrich_stream(stream, zone_frame(spark), out, cp)
    assert sorted(r["hashing_key"] for r in spark.read.parquet(out).collect()) == ["k1", "k2", "k5", "k5"]


def test_status_snapshots(spark, tmp_path):
    path = str(tmp_path / "status")
    assert processing.decide(spark, path, "20240417")["run"]
    entry = {"latest_lnd_folder": "20240417", "latest_unprocessed_folder": "20240417", "status": "unprocessed", "execution_dt": "20240505"}
    processing.store_status(spark, path, "", entry)
    assert processing.decide(spark, path, "20240417")["reason"] == "unprocessed_folder"
    processing.store_status(spark, path, "20240417", None)
    assert processing.decide(spark, path, "20240417")["reason"] == "already_processed"
    assert processing.decide(spark, path, "20240418")["reason"] == "new_folder"
    assert processing.status_history(spark, path).count() == 1
