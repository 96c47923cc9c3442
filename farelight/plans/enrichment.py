"""Trip enrichment: cleaned trips + zones -> enriched trips, only the new ones.

    python -m farelight.plans.enrichment --trips DIR --zones FILE --output DIR --trip-type short_trip
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from farelight.operators.enrich import indexed_enrich
from farelight.session import build_session, release_kept
from farelight.sources import sinks
from farelight.sources.key_index import KeyIndex
from farelight.sources.tables import table_scan
from farelight.sources.zones import zones_scan


def run(
    spark: SparkSession, trips_path: str, zones_path: str, output: str, trip_type: str | None = None, dedupe_batch: bool = False,
    keys_path: str | None = None,
) -> int:
    """Append the enriched form of unseen trips; return how many rows were appended.

    The keys of what is stored are in an index, by default beside the output. One run at a time writes to an output.
    """
    trips = table_scan(spark, trips_path)
    if trip_type:
        trips = trips.filter(F.col("trip_type") == trip_type)
    index = KeyIndex(spark, keys_path or f"{output.rstrip('/')}-keys")
    number = index.begin(output)
    rows = indexed_enrich(trips, index, zones_scan(spark, zones_path), number, dedupe_batch)
    appended = sinks.partitioned_append(rows, output)
    index.finish(number)
    release_kept()
    return appended


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--trips", required=True)
    parser.add_argument("--zones", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--trip-type", choices=["short_trip", "long_trip"])
    parser.add_argument("--dedupe-batch", action="store_true")
    args = parser.parse_args(argv)
    spark = build_session("trip-enrichment")
    print(run(spark, args.trips, args.zones, args.output, args.trip_type, args.dedupe_batch), "rows appended")


if __name__ == "__main__":
    main()
