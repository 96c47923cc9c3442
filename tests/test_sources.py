import json
import os

import pytest
from pyspark.sql import functions as F

from farelight.sources import checkpoints, landing, sinks, snapshots, tables
from farelight.sources.zones import zones_raw_scan


def raw_row(i, width=18):
    row = {name: str(i) for name in landing.LANDING_COLUMNS}
    row.update({f"unused_{j}": "0" for j in range(width - len(row))})
    return row


def write_array(path, rows):
    with open(path, "w") as f:
        json.dump(rows, f, indent=4)


def test_array_files_in_one_scan(spark, tmp_path):
    write_array(tmp_path / "a.json", [raw_row(1), raw_row(2)])
    write_array(tmp_path / "b.json", [raw_row(3)])
    rows = landing.landing_scan(spark, str(tmp_path)).collect()
    assert sorted((r["trip_distance"], r["batch_id"]) for r in rows) == [("1", "a.json"), ("2", "a.json"), ("3", "b.json")]
    assert list(rows[0].asDict()) == [*landing.LANDING_COLUMNS, "batch_id"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_guard_drops_files_of_another_width(spark, tmp_path, multi_line):
    files = {"a": [raw_row(1), raw_row(2)], "b": [raw_row(3, 17)], "c": [raw_row(4, 17), raw_row(5, 18)], "d": [raw_row(6, 19)]}
    for name, rows in files.items():
        if multi_line:
            write_array(tmp_path / f"{name}.json", rows)
        else:
            (tmp_path / f"{name}.json").write_text("\n".join(json.dumps(r) for r in rows))
    widths = {r["batch_id"]: r["width"] for r in landing.file_widths(spark, str(tmp_path), multi_line).collect()}
    assert widths == {"a.json": 18, "b.json": 17, "c.json": 18, "d.json": 19}
    kept = landing.file_schema_guard(spark, str(tmp_path), multi_line=multi_line).collect()
    assert sorted(r["trip_distance"] for r in kept) == ["1", "2", "4", "5"]


def test_concat_of_nothing_is_empty(spark):
    empty = landing.multi_file_concat([], landing.landing_schema(), spark)
    assert empty.count() == 0 and len(empty.columns) == 10


def test_zone_file(spark, tmp_path):
    geom = {"type": "MultiPolygon", "coordinates": [[[[-73.9, 40.1], [-73.8, 40.1], [-73.8, 40.2], [-73.9, 40.1]]]]}
    write_array(tmp_path / "z.json", [{"objectid": "1", "zone": "Astoria", "the_geom": geom}])
    row = zones_raw_scan(spark, str(tmp_path / "z.json")).first()
    assert row["the_geom"]["coordinates"][0][0][0] == [-73.9, 40.1] and row["shape_leng"] is None


def test_partition_scan_prunes(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "short_trip", "202101"), (2, "short_trip", "202102"), (3, "long_trip", "202101")], "i int, trip_type string, partition_dt string")
    sinks.partitioned_append(rows, path)
    found = tables.partition_scan(spark, path, "202101")
    assert sorted((r["i"], r["partition_dt"]) for r in found.collect()) == [(1, "202101"), (3, "202101")]
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "202101" in plan[plan.index("PartitionFilters") :].split("\n")[0]
    missing = tables.partition_scan(spark, str(tmp_path / "none"), "202101", rows.schema)
    assert missing.count() == 0 and missing.columns == rows.columns


def test_training_scan_reads_only_its_columns(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.range(5).select("id", *[F.lit(1.0).alias(c) for c in tables.COST_COLUMNS], F.lit("x").alias("trip_distance")).write.parquet(path)
    tables.training_scan(spark, path, ("trip_cost", "trip_duration")).explain("formatted")
    assert "ReadSchema: struct<trip_cost:double,trip_duration:double>" in capsys.readouterr().out


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "short_trip", "202101"), (2, "short_trip", "202102")], "i int, trip_type string, partition_dt string")
    sinks.partitioned_append(rows, path)
    sinks.partitioned_append(rows, path)
    assert tables.table_scan(spark, path).count() == 4
    sinks.overwrite_months(rows.filter("i = 1"), path)
    assert sorted(r["i"] for r in tables.table_scan(spark, path).collect()) == [1, 2, 2]
    sinks.rerun_overwrite(rows, path)
    assert tables.table_scan(spark, path).count() == 2


def test_text_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"v,{i}" if i % 2 else None) for i in range(10)], "i int, v string")
    sinks.ndjson_sink(rows, str(tmp_path / "n"))
    assert sorted(map(tuple, spark.read.schema(rows.schema).json(str(tmp_path / "n")).collect())) == sorted(map(tuple, rows.collect()))
    sinks.json_array_sink(rows, str(tmp_path / "j"), F.floor(F.col("i") / 4))
    documents = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert sorted(len(d) for d in documents) == [2, 4, 4] and documents[0][0].keys() == {"i", "v"}
    sinks.csv_sink(rows.filter("v is not null").coalesce(1), str(tmp_path / "c"))
    back = spark.read.option("header", True).csv(str(tmp_path / "c")).collect()
    assert {r["v"] for r in back} == {f"v,{i}" for i in range(1, 10, 2)}


def test_newest_file_and_folder(spark, tmp_path):
    for age, name in enumerate(["20240518/a_data.json", "20240517/b_zones.json", "20240516/c_data.json"]):
        path = tmp_path / name
        path.parent.mkdir()
        path.write_text("[]")
        os.utime(path, (1_700_000_000 - age * 1000, 1_700_000_000 - age * 1000))
    (tmp_path / "20240601").mkdir()
    files = snapshots.list_files(spark, str(tmp_path))
    assert snapshots.latest_file(files).first()["path"].endswith("20240518/a_data.json")
    assert snapshots.latest_file(files, "_zones.json").first()["path"].endswith("b_zones.json")
    assert snapshots.latest_file(files, "_none.json").first()["path"] is None
    assert snapshots.latest_folder(files, str(tmp_path)).first()["folder_name"] == "20240518"
    assert snapshots.latest_dated_folder(files, str(tmp_path)).first()["folder_name"] == "20240518"


def test_scores_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(i, "m", float(i), 0.5, 0.1, 0.0) for i in range(1, 2500)],
                                 "chunk_id bigint, model_path string, rmse double, r2 double, mae double, percentage_improvement double")
    checkpoints.scores_sink(rows, str(tmp_path / "s"))
    back = checkpoints.scores_scan(spark, str(tmp_path / "s"))
    assert back.count() == 2499 and back.filter("chunk_id = 2400").first()["rmse"] == 2400.0
    assert spark.read.text(str(tmp_path / "s")).count() == 3
    single = tmp_path / "one.json"
    single.write_text(json.dumps({"chunk_1": {"model_path": "m", "rmse": 2.0, "r2": 0.1, "mae": 1.0, "percentage_improvement": 0.0}}))
    assert checkpoints.scores_scan(spark, str(single)).first()["chunk"] == "chunk_1"


def trip_array(n, **changed):
    return [{name: f"{name} {i}, [x]" for name in landing.LANDING_COLUMNS} | {"other": "é\\n\"", **changed} for i in range(n)]


ARRAYS = {
    "flat": json.dumps(trip_array(60)),
    "indented": json.dumps(trip_array(60), indent=3, ensure_ascii=False),
    "one": json.dumps(trip_array(1)),
    "empty": " [ ] \n",
    "brace": json.dumps([*trip_array(20), *trip_array(1, other="},{"), *trip_array(20, fare_amount="}")]),
    "nested": json.dumps(trip_array(30, other={"a": {"b": 1}})),
    "number": json.dumps(trip_array(30, fare_amount=2.5)),
    "null": json.dumps(trip_array(30, fare_amount=None)),
    "lines": "\n".join(json.dumps(r) for r in trip_array(20)),
    "cut": json.dumps(trip_array(20))[:-2],
    "mixed": json.dumps([1, *trip_array(3)]),
}


@pytest.mark.parametrize("name", ARRAYS)
def test_split_arrays_are_read_as_whole_ones(spark, tmp_path, name):
    (tmp_path / "a.json").write_text(ARRAYS[name], encoding="utf-8")
    (tmp_path / "b.json").write_text(ARRAYS["flat"], encoding="utf-8")
    expected = landing._json_scan(spark, str(tmp_path), landing.LANDING_COLUMNS, True, "*.json")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    try:
        found = landing.array_scan(spark, str(tmp_path), split_above=0)
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(map(tuple, found.collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)
        if name == "flat":
            tasks = found.filter("batch_id = 'a.json'").select(F.spark_partition_id().alias("p")).distinct().count()
            assert tasks > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_array_files_are_written_row_by_row(spark, tmp_path, compression):
    """A file is one array, and no row of the writer holds more than one object of it."""
    rows = spark.range(1000).select(F.col("id").cast("string").alias("fare_amount"), F.when(F.col("id") % 7 > 0, "x").alias("extra"))
    path = str(tmp_path / "a")
    sinks.json_array_sink(rows, path, F.pmod(F.col("fare_amount").cast("int"), F.lit(3)), one_per_file=True, compression=compression)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert len(lines) == 1000
    files = [json.loads(r["value"]) for r in spark.read.text(path, wholetext=True).collect()]
    assert sorted(len(f) for f in files) == [333, 333, 334] and all(r.keys() == {"fare_amount", "extra"} for f in files for r in f)
    glob = "*.txt" if compression == "none" else "*.txt.gz"
    for above in (None, 100):
        found = landing.array_scan(spark, path, ("fare_amount", "extra"), glob, above)
        assert sorted(map(tuple, found.select("fare_amount", "extra").collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_empty_array_table(spark, tmp_path):
    rows = spark.createDataFrame([], "fare_amount string")
    sinks.json_array_sink(rows, str(tmp_path / "a"), F.lit(1), one_per_file=True)
    assert landing.array_scan(spark, str(tmp_path / "a"), ("fare_amount",), "*.txt").count() == 0


def test_landing_files_of_the_queries_are_packed(spark, sf_dir):
    from farelight.catalog import storage

    wide, narrow = storage._write_landing(spark, sf_dir, by_batch=True)
    names = [name for path in (wide, narrow) for name in os.listdir(path) if name[0] not in "._"]
    assert names and all(name.endswith(".json.gz") for name in names)
    widths = {r["width"] for r in landing.file_widths(spark, [wide, narrow], False, storage.LANDED).collect()}
    assert widths == {17, 18}
    kept = landing.file_schema_guard(spark, [wide, narrow], multi_line=False, glob=storage.LANDED)
    assert kept.count() == landing.landing_scan(spark, wide, multi_line=False, glob=storage.LANDED).count() > 0


def test_array_files_follow_the_rows(spark, sf_dir, monkeypatch):
    from farelight.catalog import storage, views

    n = views.trips(spark, sf_dir).count()
    for most, files in ((n, 4), (-(-n // 9), 9)):
        path = storage._write_arrays(spark, sf_dir, 4, most)
        assert len([name for name in os.listdir(path) if name.startswith("page=")]) == files
