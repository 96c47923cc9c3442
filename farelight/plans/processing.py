"""Trip processing: landing files -> cleaned, month-partitioned trips.

    python -m farelight.plans.processing --landing DIR --output DIR --status DIR
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelight.functions.calendar import holiday_years, us_holidays
from farelight.operators import cleaning, incremental, projection
from farelight.session import build_session, materialize
from farelight.sources import checkpoints, sinks, snapshots
from farelight.sources.landing import landing_scan
from farelight.sources.tables import path_exists


def measured_trips(typed: DataFrame, holidays: list[date], batch: str = "batch_id") -> DataFrame:
    """All derived columns the rules look at; trips below a minute are gone.

    Calendar columns are added last, so the pass that finds the mean distances reads times,
    distance and batch only.
    """
    rows = projection.distance_km(projection.trip_duration(typed))
    rows = cleaning.zero_distance_impute(rows, batch)
    rows = projection.average_speed(projection.trip_cost(rows))
    return projection.time_features(rows, holidays)


def clean_trips(typed: DataFrame, as_of: date, holidays: list[date], batch: str = "batch_id") -> DataFrame:
    rows = cleaning.apply_rules(measured_trips(typed, holidays, batch), as_of.year)
    return projection.trip_keys(rows)


def decide(spark: SparkSession, status_path: str, landing_day: str) -> dict:
    """The gate's decision for the newest landing folder."""
    history = status_history(spark, status_path)
    status = incremental.latest_status(history).withColumn("landing_day", F.to_date(F.lit(landing_day), "yyyyMMdd"))
    return incremental.processing_gate(status).first().asDict()


def status_history(spark: SparkSession, status_path: str) -> DataFrame:
    """The newest snapshot of the status table."""
    schema = "seq bigint, " + checkpoints.STATUS_SCHEMA
    if not path_exists(spark, status_path):
        return spark.createDataFrame([], schema)
    snapshots_found = spark.read.schema(schema + ", snapshot bigint").json(status_path)
    newest = snapshots_found.agg(F.max("snapshot")).scalar()
    return snapshots_found.filter(F.col("snapshot") == newest).drop("snapshot")


def store_status(spark: SparkSession, status_path: str, folder: str, run: dict | None) -> None:
    """Write the history after this run as a new snapshot; readers see the old or the new one."""
    history = status_history(spark, status_path)
    entry = run or {"latest_lnd_folder": None, "latest_unprocessed_folder": None, "status": None, "execution_dt": None}
    runs = spark.createDataFrame(
        [(folder, entry["latest_lnd_folder"], entry["latest_unprocessed_folder"], entry["status"], entry["execution_dt"])],
        "folder string, " + checkpoints.STATUS_SCHEMA,
    )
    updated = incremental.status_upsert(history, runs)
    number = 0
    if path_exists(spark, status_path):
        found = spark.read.schema("seq bigint, snapshot bigint").json(status_path).agg(F.max("snapshot")).first()[0]
        number = 0 if found is None else found + 1
    updated.write.option("ignoreNullFields", False).json(f"{status_path}/snapshot={number}")


def run(
    spark: SparkSession, landing: str, output: str, status: str, as_of: date, multi_line: bool = False
) -> DataFrame | None:
    """Process the newest landing folder unless it was done; return the reject audit.

    Landing files hold a document per line, as collection writes them; with ``multi_line`` one array each.
    """
    files = snapshots.list_files(spark, landing, "*.json")
    newest = snapshots.latest_dated_folder(files, landing).first()["folder_name"]
    if newest is None:
        return None
    decision = decide(spark, status, newest)
    if not decision["run"]:
        return None
    today = as_of.strftime("%Y%m%d")
    entry = {"latest_lnd_folder": newest, "latest_unprocessed_folder": newest, "status": "unprocessed", "execution_dt": today}
    if decision["reason"] == "new_folder":
        store_status(spark, status, "", entry)
    # Text is parsed once; means, audit and output then read columns.
    typed = projection.typed_projection(landing_scan(spark, f"{landing}/{newest}", multi_line=multi_line))
    measured = measured_trips(materialize(typed, "typed"), us_holidays(*holiday_years(as_of)))
    audit = cleaning.reject_audit(projection.trip_keys(measured), as_of.year, ["batch_id", "trip_type"])
    audit = materialize(audit, "audit")
    kept = {row[0] for row in audit.filter(F.col("rule") == 0).select("trip_type").distinct().collect()}
    if kept != {"short_trip", "long_trip"}:
        raise ValueError(f"a trip type has no rows; found {sorted(kept)}")
    sinks.rerun_overwrite(projection.trip_keys(cleaning.apply_rules(measured, as_of.year)), f"{output}/{today}")
    store_status(spark, status, newest, None)
    return audit


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--landing", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--status", required=True)
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser.add_argument("--arrays", action="store_true", help="landing files hold one array each, not one document per line")
    args = parser.parse_args(argv)
    spark = build_session("trip-processing")
    audit = run(spark, args.landing, args.output, args.status, args.as_of, args.arrays)
    if audit is None:
        print("nothing to process")
    else:
        audit.groupBy("rule", "rule_name").agg(F.sum("n_rows").alias("n_rows")).orderBy("rule").show(20, False)


if __name__ == "__main__":
    main()
