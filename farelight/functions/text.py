"""Request parsing and answer text, as column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and phrases that decide the intent of a message.
REQUEST_WORDS = ("from", "to", "for", "at")
THANKS_PHRASES = ("thanks", "thank you", "you are the best", "helpful")

# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# What a request looks like. `{word}` is the word in front of the day.
FROM_PATTERN = r"from\s+(.*?)\s+to"
TO_PATTERN = r"(?:.*\bto\s)(.*?)(?=\s*{word}\b)"
DAY_PATTERN = r"{word}\s(\w+)\sat"
DATE_PATTERN = r"{word}\s(\w+(?:[./,-]\w+)?)\sat"
TIME_PATTERN = r"at\s([\d:]+)"
TIME_FORMAT = r"^\d{2}:\d{2}"

# Case-insensitive, Unicode classes, and only \n ends a line.
_FLAGS = "(?iuUd)"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def _capture(text: Column, pattern: str) -> Column:
    """The captured text; null when nothing, or nothing but blanks, was found."""
    return F.nullif(strip(F.regexp_extract(text, _FLAGS + pattern, 1)), F.lit(""))


def place_from(text: Column) -> Column:
    """Pickup place, without the tail after the first comma."""
    return F.split(_capture(text, FROM_PATTERN), ",")[0]


def place_to(text: Column, word: str = "for") -> Column:
    return F.split(_capture(text, TO_PATTERN.format(word=word)), ",")[0]


def day_word(text: Column, word: str = "for", allow_dates: bool = False) -> Column:
    """The day as written. The plain pattern takes one word only; ``allow_dates`` also M/D."""
    pattern = DATE_PATTERN if allow_dates else DAY_PATTERN
    return F.lower(_capture(text, pattern.format(word=word)))


def time_word(text: Column) -> Column:
    return _capture(text, TIME_PATTERN)


def is_request(text: Column) -> Column:
    lowered = F.lower(text)
    found = F.lit(True)
    for word in REQUEST_WORDS:
        found = found & lowered.contains(word)
    return found


def is_thanks(text: Column) -> Column:
    lowered = F.lower(strip_punctuation(text))
    found = F.lit(False)
    for phrase in THANKS_PHRASES:
        found = found | lowered.contains(phrase)
    return found


def intent(text: Column, is_first: Column) -> Column:
    return (
        F.when(is_request(text), "request")
        .when(is_first, "greeting")
        .when(is_thanks(text), "thanks")
        .otherwise("help")
    )


def request_status(pickup: Column, dropoff: Column, day: Column, clock: Column) -> Column:
    """ok, bad_time or incomplete, from the captured parts."""
    complete = F.lit(True)
    for part in (pickup, dropoff, day, clock):
        complete = complete & F.coalesce(part != "", F.lit(False))
    return F.when(~complete, "incomplete").when(clock.rlike(TIME_FORMAT), "ok").otherwise("bad_time")


def resolve_day(day: Column, as_of: date) -> Column:
    """today, tomorrow, a weekday of next week, or M/D of the current year -> date."""
    today = F.lit(as_of)
    resolved = F.when(day == "today", today).when(day == "tomorrow", F.date_add(today, 1))
    # Weekday names.
    names = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
    for number, name in enumerate(names):
        resolved = resolved.when(day == name, F.date_add(today, number - as_of.weekday() + 7))
    parts = F.split(F.regexp_replace(day, "[./,-]", "/"), "/")
    written = F.concat_ws("-", F.lit(f"{as_of.year:04d}"), F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))
    return resolved.otherwise(F.try_to_date(written, "yyyy-M-d"))


def clock_minutes(clock: Column) -> Column:
    """HH:MM -> minutes since midnight."""
    parts = F.split(clock, ":")
    return parts[0].try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int")


def eta(clock: Column, minutes: Column) -> Column:
    """Clock time after the whole minutes of a duration."""
    total = F.pmod(clock_minutes(clock) + minutes.cast("bigint"), F.lit(1440))
    return F.format_string("%02d:%02d", F.floor(total / 60), total % 60)


def duration_text(minutes: Column) -> Column:
    """[D day[s], ]H:MM:SS[.ffffff] of a length in minutes."""
    total = F.round(minutes * 6e7).cast("bigint")
    days = F.floor(total / 86_400_000_000)
    rest = total - days * 86_400_000_000
    seconds = F.floor(rest / 1_000_000)
    fraction = rest % 1_000_000
    return F.concat(
        F.when(days == 0, "").when(F.abs(days) == 1, F.format_string("%d day, ", days))
        .otherwise(F.format_string("%d days, ", days)),
        F.format_string("%d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60),
        F.when(fraction == 0, "").otherwise(F.format_string(".%06d", fraction)),
    )


def answer_text(minutes: Column, eta_clock: Column, cost: Column) -> Column:
    # The sentence of an answer.
    return F.concat(
        F.lit("🚕 Your trip will have an average duration of "),
        duration_text(minutes),
        F.lit("⏱ (eta: "),
        eta_clock,
        F.lit(") and it will approximately cost $"),
        F.round(cost, 2).cast("string"),
        F.lit("💸 (including taxes)."),
    )
