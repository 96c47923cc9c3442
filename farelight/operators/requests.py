"""Trip requests: parsing, features and two-step scoring of a request table."""

from __future__ import annotations

from datetime import date

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelight.functions import calendar, geo, text, trip
from farelight.operators import models


def request_extract(df: DataFrame, column: str = "text", word: str = "for", allow_dates: bool = False) -> DataFrame:
    """Add what a request names: places, day, time and whether it is complete."""
    message = F.col(column)
    parts = df.withColumns(
        {
            "pickup_place": text.place_from(message),
            "dropoff_place": text.place_to(message, word),
            "day": text.day_word(message, word, allow_dates),
            "clock": text.time_word(message),
        }
    )
    named = [F.col(name) for name in ("pickup_place", "dropoff_place", "day", "clock")]
    return parts.withColumn("request_status", text.request_status(*named))


def intent_classify(df: DataFrame, column: str = "text", turn: str = "turn") -> DataFrame:
    return df.withColumn("intent", text.intent(F.col(column), F.col(turn) == 0))


def valid_request(df: DataFrame, column: str = "text") -> DataFrame:
    """Messages with all request words and a two-digit clock time."""
    clock = text.time_word(F.col(column))
    return df.filter(text.is_request(F.col(column)) & F.coalesce(clock.rlike(text.TIME_FORMAT), F.lit(False)))


def pickup_time(df: DataFrame, as_of: date, day: str = "day", clock: str = "clock") -> DataFrame:
    """Add the pickup instant of a day word and an HH:MM clock."""
    start = text.resolve_day(F.col(day), as_of).cast("timestamp_ntz")
    minutes = text.clock_minutes(F.col(clock))
    return df.withColumn("pickup_ts", start + F.make_dt_interval(mins=minutes))


def _minutes(ts: Column, since_month: bool) -> Column:
    minutes = calendar.minutes_of_day(ts)
    return minutes + (F.dayofmonth(ts) - 1) * 1440 if since_month else minutes


def end_features(
    df: DataFrame, end: str, ts: Column, holidays: list[date], quarter_base: int = 0, since_month: bool = False
) -> DataFrame:
    """Model features of one trip end.

    Models are trained on quarters 0..95 and minutes since midnight, so these are the
    defaults; ``quarter_base=1`` and ``since_month=True`` give the numbers the interactive
    advisor showed its models.
    """
    return df.withColumns(
        {
            f"{end}_daytime": calendar.daytime(ts),
            f"{end}_hour": calendar.hour(ts),
            f"{end}_weekday": calendar.iso_weekday(ts),
            f"{end}_quarter": (calendar.quarter_of_day(ts) + quarter_base).cast("tinyint"),
            f"{end}_seconds": _minutes(ts, since_month),
            f"{end}_holiday": calendar.holiday_flag(ts, holidays),
            f"{end}_weekend": calendar.weekend_flag(ts),
        }
    )


def request_distances(df: DataFrame) -> DataFrame:
    """Add ``haversine_centroid_distance`` of the places' coordinates, in km.

    Needs ``pickup_lon``, ``pickup_lat``, ``dropoff_lon`` and ``dropoff_lat``. It also stands in for
    ``trip_distance`` where no driven distance is given.
    """
    ends = [geo.radians(F.col(c)) for c in ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")]
    rows = df.withColumn("haversine_centroid_distance", geo.haversine_from_radians(*ends))
    given = F.col("trip_distance") if "trip_distance" in df.columns else F.lit(None).cast("double")
    return rows.withColumn("trip_distance", F.coalesce(given, F.col("haversine_centroid_distance")))


def dropoff_time(pickup: Column, minutes: Column) -> Column:
    return pickup + F.make_dt_interval(secs=F.round(minutes * 60, 6).cast("decimal(18,6)"))


def batch_score(
    requests: DataFrame,
    duration_models: dict[str, list[Transformer]],
    cost_models: dict[str, list[Transformer]],
    holidays: list[date],
    long_trip_km: float = trip.LONG_TRIP_KM,
) -> DataFrame:
    """Predicted duration, dropoff, cost and answer for requests.

    Needs ``pickup_ts``, ``trip_distance`` (km) and ``haversine_centroid_distance``. Requests
    go to the models of their trip type; the predicted duration feeds the cost models. All requests come back:
    ``score_status`` is ``ok``, or ``no_model`` for a trip type that lacks models for either target and ``no_distance``
    without a trip distance, with nulls for what could not be predicted.
    """
    rows = requests.withColumn("trip_type", trip.trip_type(F.col("trip_distance"), long_trip_km))
    rows = end_features(rows, "pickup", F.col("pickup_ts"), holidays)
    served = [kind for kind in duration_models if duration_models[kind] and cost_models.get(kind)]
    known = F.coalesce(F.col("trip_type").isin(served) & F.col("trip_distance").isNotNull(), F.lit(False)) if served else F.lit(False)
    rest = rows.filter(~known).withColumns(
        {"trip_duration": F.lit(None).cast("double"), "trip_cost": F.lit(None).cast("double")}
    )
    rest = rest.withColumn("dropoff_ts", F.lit(None).cast("timestamp_ntz"))
    rest = end_features(rest, "dropoff", F.col("dropoff_ts"), holidays)
    status = F.when(F.col("trip_distance").isNull(), "no_distance").otherwise("no_model")
    scored = rest.withColumn("score_status", status)
    for kind in served:
        part = rows.filter(known & (F.col("trip_type") == kind))
        part = models.ensemble_mean(part, duration_models[kind], "trip_duration")
        part = part.withColumn("dropoff_ts", dropoff_time(F.col("pickup_ts"), F.col("trip_duration")))
        part = end_features(part, "dropoff", F.col("dropoff_ts"), holidays)
        part = models.ensemble_mean(part, cost_models[kind], "trip_cost")
        scored = part.withColumn("score_status", F.lit("ok")).unionByName(scored)
    clock = F.date_format("pickup_ts", "HH:mm")
    eta = F.when(F.col("score_status") == "ok", text.eta(clock, F.col("trip_duration")))
    answer = text.answer_text(F.col("trip_duration"), F.col("eta"), F.col("trip_cost"))
    return scored.withColumn("eta", eta).withColumn("answer", F.when(F.col("score_status") == "ok", answer))
