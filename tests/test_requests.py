from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farelight.functions import text
from farelight.operators import requests

AS_OF = date(2024, 5, 16)  # a Thursday


def parse(spark, message, **options):
    return requests.request_extract(spark.createDataFrame([(message,)], "text string"), **options).first()


def test_whole_request(spark):
    row = parse(spark, "I would like to go from Lantern Museum, Northgate to Glass House, Long Meadow for tomorrow at 21:00")
    assert (row["pickup_place"], row["dropoff_place"], row["day"], row["clock"]) == ("Lantern Museum", "Glass House", "tomorrow", "21:00")
    assert row["request_status"] == "ok"


def test_upper_case_and_other_word(spark):
    assert parse(spark, "GO FROM A TO B FOR FRIDAY AT 08:30")["day"] == "friday"
    row = parse(spark, "a trip from Lantern museum to Garden, Long Meadow on tomorrow at 21:00", word="on")
    assert (row["dropoff_place"], row["day"], row["request_status"]) == ("Garden", "tomorrow", "ok")


def test_dates_need_the_wider_pattern(spark):
    message = "go from A to B for 3/14 at 09:00"
    assert parse(spark, message)["request_status"] == "incomplete"
    assert parse(spark, message, allow_dates=True)["day"] == "3/14"


def test_bad_time_and_missing_parts(spark):
    assert parse(spark, "go from A to B for today at 9:00")["request_status"] == "bad_time"
    row = parse(spark, "go from A to B")
    assert row["request_status"] == "incomplete" and row["day"] is None


@pytest.mark.parametrize("message,turn,intent", [
    ("from a to b for today at 10:00", 3, "request"), ("hi", 0, "greeting"), ("Thank, you!", 2, "thanks"),
    ("You are the best...", 1, "thanks"), ("what?", 1, "help"),
])
def test_intent(spark, message, turn, intent):
    row = requests.intent_classify(spark.createDataFrame([(message, turn)], "text string, turn int")).first()
    assert row["intent"] == intent


def test_days(spark):
    words = ["today", "tomorrow", "thursday", "monday", "sunday", "3/14", "12-25", "2.30", "never"]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, day string")
    got = [r[0] for r in rows.orderBy("i").select(text.resolve_day(F.col("day"), AS_OF)).collect()]
    assert got == [date(2024, 5, 16), date(2024, 5, 17), date(2024, 5, 23), date(2024, 5, 20), date(2024, 5, 26),
                   date(2024, 3, 14), date(2024, 12, 25), None, None]


def test_eta_and_answer(spark):
    rows = spark.createDataFrame([("23:50", 12.31, 15.2), ("08:00", 30.0, 20.0), ("08:00", 1500.5, 1.0)], "c string, m double, cost double")
    got = rows.select(text.eta(F.col("c"), F.col("m")), text.duration_text(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [("00:02", "0:12:18.600000"), ("08:30", "0:30:00"), ("09:00", "1 day, 1:00:30")]
    sentence = rows.select(text.answer_text(F.col("m"), F.lit("00:02"), F.col("cost"))).first()[0]
    assert sentence == "🚕 Your trip will have an average duration of 0:12:18.600000⏱ (eta: 00:02) and it will approximately cost $15.2💸 (including taxes)."


def test_features_of_both_conventions(spark):
    rows = spark.createDataFrame([(datetime(2024, 5, 16, 7, 20),)], "ts timestamp_ntz")
    plain = requests.end_features(rows, "pickup", F.col("ts"), [date(2024, 5, 16)]).first()
    assert (plain["pickup_quarter"], plain["pickup_seconds"], plain["pickup_holiday"], plain["pickup_daytime"]) == (29, 440, 1, 1)
    advisor = requests.end_features(rows, "pickup", F.col("ts"), [], 1, True).first()
    assert (advisor["pickup_quarter"], advisor["pickup_seconds"]) == (30, 15 * 1440 + 440)


def test_strip_punctuation(spark):
    rows = spark.createDataFrame([("a!b\\c]d-e_é",)], "t string")
    assert rows.select(text.strip_punctuation(F.col("t"))).first()[0] == "abcdeé"
