"""Queries: request texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelight.catalog import views
from farelight.catalog.registry import AS_OF, query
from farelight.functions import text
from farelight.operators import requests

PARTS = r"""
    (SELECT conv_id, text,
       nullif(split_part(trim(regexp_extract(text, '(?i)from\s+(.*?)\s+to', 1)), ',', 1), '') AS pickup_place,
       nullif(split_part(trim(regexp_extract(text, '(?i)(?:.*\bto\s)(.*?)\s*for\b', 1)), ',', 1), '') AS dropoff_place,
       nullif(lower(regexp_extract(text, '(?i)for\s(\w+(?:[./,-]\w+)?)\sat', 1)), '') AS day,
       nullif(lower(regexp_extract(text, '(?i)for\s(\w+)\sat', 1)), '') AS strict_day,
       nullif(regexp_extract(text, '(?i)at\s([\d:]+)', 1), '') AS clock FROM request_texts)"""


@query(
    "request_extract",
    f"""SELECT conv_id, pickup_place, dropoff_place, strict_day AS day, clock,
        CASE WHEN pickup_place IS NULL OR dropoff_place IS NULL OR strict_day IS NULL OR clock IS NULL THEN 'incomplete'
             WHEN regexp_matches(clock, '^\\d{{2}}:\\d{{2}}') THEN 'ok' ELSE 'bad_time' END AS request_status FROM {PARTS}""",
    ("request_texts",),
)
def request_extract(spark, sf_dir):
    return requests.request_extract(views.request_texts(spark, sf_dir)).drop("turn", "text")


@query(
    "request_extract_dates",
    f"""SELECT conv_id, pickup_place, dropoff_place, day, clock,
        CASE WHEN pickup_place IS NULL OR dropoff_place IS NULL OR day IS NULL OR clock IS NULL THEN 'incomplete'
             WHEN regexp_matches(clock, '^\\d{{2}}:\\d{{2}}') THEN 'ok' ELSE 'bad_time' END AS request_status FROM {PARTS}""",
    ("request_texts",),
)
def request_extract_dates(spark, sf_dir):
    return requests.request_extract(views.request_texts(spark, sf_dir), allow_dates=True).drop("turn", "text")


SAID_ON = PARTS.replace("for", "on").replace("FROM request_texts", "FROM (SELECT * REPLACE (regexp_replace(text, '(?i)\\bfor\\b', 'on', 'g') AS text) FROM request_texts)")


@query(
    "request_extract_on",
    f"""SELECT conv_id, pickup_place, dropoff_place, strict_day AS day, clock,
        CASE WHEN pickup_place IS NULL OR dropoff_place IS NULL OR strict_day IS NULL OR clock IS NULL THEN 'incomplete'
             WHEN regexp_matches(clock, '^\\d{{2}}:\\d{{2}}') THEN 'ok' ELSE 'bad_time' END AS request_status FROM {SAID_ON}""",
    ("request_texts",),
)
def request_extract_on(spark, sf_dir):
    """The same requests, naming the day with "on"."""
    rows = views.request_texts(spark, sf_dir)
    rows = rows.withColumn("text", F.regexp_replace("text", r"(?i)\bfor\b", "on"))
    return requests.request_extract(rows, word="on").drop("turn", "text")


MESSAGES = "(SELECT conv_id, turn, text FROM request_texts UNION ALL SELECT conv_id, turn, text FROM conversations)"
PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"


def _messages(spark, sf_dir):
    chats = views.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return views.request_texts(spark, sf_dir).unionByName(chats)


@query(
    "intent_classify",
    f"""SELECT conv_id, turn, CASE WHEN contains(l, 'from') AND contains(l, 'to') AND contains(l, 'for') AND contains(l, 'at') THEN 'request'
          WHEN turn = 0 THEN 'greeting'
          WHEN contains(p, 'thanks') OR contains(p, 'thank you') OR contains(p, 'you are the best') OR contains(p, 'helpful') THEN 'thanks'
          ELSE 'help' END AS intent
        FROM (SELECT conv_id, turn, lower(text) AS l, lower(translate(text, '{PUNCTUATION}', '')) AS p FROM {MESSAGES})""",
    ("request_texts",),
)
def intent_classify(spark, sf_dir):
    return requests.intent_classify(_messages(spark, sf_dir)).select("conv_id", "turn", "intent")


@query(
    "strip_punctuation",
    f"SELECT conv_id, turn, translate(text, '{PUNCTUATION}', '') AS stripped FROM {MESSAGES}",
    ("request_texts",),
)
def strip_punctuation(spark, sf_dir):
    return _messages(spark, sf_dir).select("conv_id", "turn", text.strip_punctuation(F.col("text")).alias("stripped"))


RESOLVED = f"""
    (SELECT conv_id, day, clock, CASE day WHEN 'today' THEN DATE '2026-12-31' WHEN 'tomorrow' THEN DATE '2027-01-01'
        WHEN 'monday' THEN DATE '2027-01-04' WHEN 'friday' THEN DATE '2027-01-08' WHEN 'sunday' THEN DATE '2027-01-10'
        ELSE try_strptime('2026/' || day, '%Y/%m/%d')::DATE END AS pickup_day FROM {PARTS})"""


@query("resolve_day", f"SELECT conv_id, day, pickup_day FROM {RESOLVED}", ("request_texts",))
def resolve_day(spark, sf_dir):
    rows = requests.request_extract(views.request_texts(spark, sf_dir), allow_dates=True)
    return rows.select("conv_id", "day", text.resolve_day(F.col("day"), AS_OF).alias("pickup_day"))


@query(
    "pickup_time",
    f"""SELECT conv_id, pickup_day::TIMESTAMP + to_minutes(split_part(clock, ':', 1)::BIGINT * 60 + split_part(clock, ':', 2)::BIGINT) AS pickup_ts
        FROM {RESOLVED}""",
    ("request_texts",),
)
def pickup_time(spark, sf_dir):
    rows = requests.request_extract(views.request_texts(spark, sf_dir), allow_dates=True)
    return requests.pickup_time(rows, AS_OF).select("conv_id", "pickup_ts")


@query(
    "eta",
    "SELECT trip_key, strftime(tpep_pickup_datetime + to_minutes(floor(trip_duration)::BIGINT), '%H:%M') AS eta FROM timed",
    ("timed",),
)
def eta(spark, sf_dir):
    clock = F.date_format("tpep_pickup_datetime", "HH:mm")
    return views.timed(spark, sf_dir).select("trip_key", text.eta(clock, F.col("trip_duration")).alias("eta"))


@query(
    "answer_text",
    """SELECT trip_key, concat('🚕 Your trip will have an average duration of ', s // 3600, ':', lpad((s // 60 % 60)::VARCHAR, 2, '0'), ':',
          lpad((s % 60)::VARCHAR, 2, '0'), CASE WHEN us % 1000000 = 0 THEN '' ELSE '.' || lpad((us % 1000000)::VARCHAR, 6, '0') END,
          '⏱ (eta: ', strftime(tpep_pickup_datetime + to_minutes(floor(trip_duration)::BIGINT), '%H:%M'),
          ') and it will approximately cost $', trip_cost::VARCHAR, '💸 (including taxes).') AS answer
       FROM (SELECT *, us // 1000000 AS s FROM (SELECT *, round(trip_duration * 6e7)::BIGINT AS us,
             round(fare_amount + extra + mta_tax + tolls_amount + improvement_surcharge, 2) AS trip_cost FROM timed))""",
    ("timed",),
)
def answer_text(spark, sf_dir):
    from farelight.operators import projection

    rows = projection.trip_cost(views.timed(spark, sf_dir))
    eta_clock = text.eta(F.date_format("tpep_pickup_datetime", "HH:mm"), F.col("trip_duration"))
    return rows.select("trip_key", text.answer_text(F.col("trip_duration"), eta_clock, F.col("trip_cost")).alias("answer"))
