"""Zone processing: raw polygon file -> zone dimension.

    python -m farelight.plans.zones --raw FILE --output DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from farelight.operators.cleaning import null_report
from farelight.operators.zones import build_zones
from farelight.session import build_session
from farelight.sources.sinks import ndjson_sink
from farelight.sources.zones import ZONE_SCHEMA, zones_raw_scan


def run(spark: SparkSession, raw: str, output: str, multi_line: bool = True) -> DataFrame:
    """Write the dimension and return its report of null values."""
    ndjson_sink(build_zones(zones_raw_scan(spark, raw, multi_line)), output, "overwrite")
    return null_report(spark.read.schema(ZONE_SCHEMA).json(output), only_nulls=True)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True)
    parser.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    run(build_session("zone-processing"), args.raw, args.output).show()


if __name__ == "__main__":
    main()
