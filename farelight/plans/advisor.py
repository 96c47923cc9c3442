"""Advisor: a table of request texts -> predicted duration, cost and answer.

    python -m farelight.plans.advisor --requests DIR --models DIR --output DIR
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelight.functions.calendar import us_holidays
from farelight.operators import models, requests
from farelight.session import build_session
from farelight.sources.tables import path_exists


COORDINATES = ("pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")


def load_models(spark: SparkSession, root: str, target: str, trip_type: str) -> list[PipelineModel]:
    """The stored regressors of a target and trip type."""
    paths = [f"{root}/{target}/{trip_type}/models/{name}" for name in models.REGRESSORS]
    return [PipelineModel.load(path) for path in paths if path_exists(spark, path)]


def latest_model_root(spark: SparkSession, root: str) -> str:
    """The newest dated run below ``root``; ``root`` itself when runs are not dated."""
    from farelight.sources import snapshots

    newest = snapshots.latest_dated_folder(snapshots.list_files(spark, root), root).first()["folder_name"]
    return f"{root}/{newest}" if newest else root


def run(spark: SparkSession, texts: DataFrame, root: str, as_of: date) -> DataFrame:
    """Answers to the complete requests among ``texts``; a request without models or distance keeps its row and a status.

    ``texts`` carries the distances of its places, ``trip_distance`` in km and ``haversine_centroid_distance``, or
    their coordinates (``pickup_lon``, ``pickup_lat``, ``dropoff_lon``, ``dropoff_lat``), from which distances are computed.
    """
    parsed = requests.request_extract(requests.intent_classify(texts), allow_dates=True)
    parsed = parsed.filter((F.col("intent") == "request") & (F.col("request_status") == "ok"))
    timed = requests.pickup_time(parsed, as_of).filter(F.col("pickup_ts").isNotNull())
    if set(COORDINATES) <= set(timed.columns):
        timed = requests.request_distances(timed)
    base = latest_model_root(spark, root)
    kinds = ("short_trip", "long_trip")
    duration = {kind: load_models(spark, base, "duration", kind) for kind in kinds}
    cost = {kind: load_models(spark, base, "cost", kind) for kind in kinds}
    holidays = us_holidays(as_of.year, as_of.year + 1)
    return requests.batch_score(timed, duration, cost, holidays)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--requests", required=True)
    parser.add_argument("--models", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    args = parser.parse_args(argv)
    spark = build_session("trip-advisor")
    run(spark, spark.read.parquet(args.requests), args.models, args.as_of).write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
