"""Collection: rows above the stored mark from a drop directory into landing files of JSON lines.

    python -m farelight.plans.collection 2024-05-01 --drops DIR --landing DIR --marks DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from farelight.operators import incremental, projection
from farelight.session import build_session
from farelight.sources.landing import landing_schema
from farelight.streaming.ingest import incremental_ingest, landing_stream


def checked_threshold(spark: SparkSession, text: str, as_of: date) -> datetime:
    row = incremental.date_string_validation(
        spark.createDataFrame([(text,)], "day string"), "day", as_of.year
    ).first()
    if row["check"] != "ok":
        raise ValueError(f"{row['check']}: {text} (expected YYYY-MM-DD)")
    return datetime.fromisoformat(row["threshold"])


def run(spark: SparkSession, threshold: str, drops: str, landing: str, marks: str, checkpoint: str, as_of: date) -> None:
    until = checked_threshold(spark, threshold, as_of)
    raw = landing_stream(spark, drops, landing_schema())
    pickup = F.to_timestamp_ntz("tpep_pickup_datetime", F.lit(projection.DATETIME_FORMAT))
    today = as_of.strftime("%Y%m%d")
    rows = raw.withColumn("pickup_ts", pickup)
    incremental_ingest(rows, "pickup_ts", f"{landing}/{today}", marks, checkpoint, until, today, fmt="json")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("threshold")
    parser.add_argument("--drops", required=True)
    parser.add_argument("--landing", required=True)
    parser.add_argument("--marks", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    args = parser.parse_args(argv)
    spark = build_session("trip-collection")
    run(spark, args.threshold, args.drops, args.landing, args.marks, args.checkpoint, args.as_of)


if __name__ == "__main__":
    main()
