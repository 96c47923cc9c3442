"""High-water marks, processing status and the decisions made from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the mark before anything was collected.
FIRST_MARK = "1970-01-01T00:00:00"
FIRST_DAY = "1970-01-01"


def incremental_extract(df: DataFrame, ts: str, mark: datetime, threshold: datetime | None = None) -> DataFrame:
    """Rows after the stored mark, up to and including the threshold if there is one."""
    rows = df.filter(F.col(ts) > F.lit(mark).cast("timestamp_ntz"))
    return rows if threshold is None else rows.filter(F.col(ts) <= F.lit(threshold).cast("timestamp_ntz"))


def deferred_extract(kept: DataFrame, ts: str, taken: str, threshold: datetime) -> DataFrame:
    """Rows kept aside that a threshold reaches for the first time; ``taken`` is the column of the highest earlier threshold, or null."""
    reached = F.col(ts) <= F.lit(threshold).cast("timestamp_ntz")
    return kept.filter(reached & (F.col(taken).isNull() | (F.col(ts) > F.col(taken))))


def max_event_time(df: DataFrame, ts: str, page: str) -> DataFrame:
    return df.groupBy(page).agg(F.max(ts).alias("max_date"))


def checkpoint_rows(marks: DataFrame, execution_date: str, value: str = "max_date") -> DataFrame:
    """Stored form of checkpoint rows: ISO text and the run date."""
    iso = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(value, "SSSSSS")
    text = F.when(fraction == "000000", iso).otherwise(F.concat_ws(".", iso, fraction))
    return marks.select(text.alias("max_date"), F.lit(execution_date).alias("execution_date"))


def high_water_mark(checkpoints: DataFrame) -> DataFrame:
    """One row: the greatest stored mark, the first mark when none is stored."""
    stored = F.max(F.col("max_date").cast("timestamp_ntz"))
    return checkpoints.agg(F.coalesce(stored, F.lit(FIRST_MARK).cast("timestamp_ntz")).alias("mark"))


def latest_status(history: DataFrame, by: tuple[str, ...] = (), seq: str = "seq") -> DataFrame:
    """The entry of the greatest landing folder, the earliest entry of equals; defaults when empty."""
    entry = F.struct("latest_lnd_folder", "latest_unprocessed_folder", "status")
    newest = F.max_by(entry, F.struct(F.col("latest_lnd_folder"), -F.col(seq)))
    day = F.to_date("e.latest_lnd_folder", "yyyyMMdd")
    return (
        history.groupBy(*by)
        .agg(newest.alias("e"))
        .select(
            *by,
            F.coalesce(day, F.lit(FIRST_DAY).cast("date")).alias("last_processed"),
            F.to_date("e.latest_unprocessed_folder", "yyyyMMdd").alias("unprocessed"),
            F.col("e.status").alias("status"),
        )
    )


def processing_gate(status: DataFrame, landing_day: str = "landing_day") -> DataFrame:
    """Add ``run`` and ``reason``: is there a landing folder to process?"""
    pending = F.col("unprocessed").isNotNull() & F.coalesce(F.col("status") == "unprocessed", F.lit(False))
    done = F.col("unprocessed").isNotNull() & F.coalesce(F.col("status") == "processed", F.lit(False))
    reason = (
        F.when(F.col(landing_day) > F.col("last_processed"), "new_folder")
        .when(pending, "unprocessed_folder")
        .when(done, "already_processed")
        .otherwise("no_unprocessed_folder")
    )
    return status.withColumn("reason", reason).withColumn("run", F.col("reason").isin("new_folder", "unprocessed_folder"))


def status_upsert(history: DataFrame, runs: DataFrame, by: tuple[str, ...] = (), seq: str = "seq") -> DataFrame:
    """The history after ``runs``: at most one run per key.

    When the newest entry (by ``execution_dt``) is unprocessed and of the run's folder, it
    becomes processed; otherwise the run's own entry is appended, if it has one (non-null
    ``status``). Entries are found by key and position, so a long history does not pile up.
    """
    columns = history.columns
    if not by:
        by = ("_all",)
        history, runs = history.withColumn("_all", F.lit(1)), runs.withColumn("_all", F.lit(1))
    newest = history.groupBy(*by).agg(
        F.max_by(F.struct(seq, "status", "latest_unprocessed_folder"), F.struct(F.col("execution_dt"), -F.col(seq))).alias("e"),
        F.max(seq).alias("_last"),
    )
    joined = runs.join(newest, list(by), "left")
    same = (F.col("e.status") == "unprocessed") & (F.col("e.latest_unprocessed_folder") == F.col("folder"))
    decided = joined.withColumn("_flip", F.coalesce(same, F.lit(False)))
    flips = decided.filter("_flip").select(*by, F.col(f"e.{seq}").alias(seq), F.lit(True).alias("_flip"))
    kept = (
        history.join(flips, [*by, seq], "left")
        .withColumn("status", F.when(F.col("_flip"), "processed").otherwise(F.col("status")))
        .select(*columns)
    )
    appended = (
        decided.filter(~F.col("_flip") & F.col("status").isNotNull())
        .withColumn(seq, F.coalesce(F.col("_last"), F.lit(-1)) + 1)
        .select(*columns)
    )
    return kept.unionByName(appended)


def date_check(text: Column, as_of_year: int) -> Column:
    """ok, or what is wrong with a ``YYYY-MM-DD`` threshold."""
    parts = F.split(text, "-")
    year, month, day = [F.get(parts, F.lit(i)).try_cast("int") for i in range(3)]
    return (
        F.when(year.isNull() | month.isNull() | day.isNull(), "invalid_date")
        .when(year > as_of_year, "invalid_year")
        .when(month > 12, "invalid_month")
        .when((day < 1) | (day > 31), "invalid_day")
        .when(F.try_to_date(text, "yyyy-M-d").isNull(), "invalid_date")
        .otherwise("ok")
    )


def date_string_validation(df: DataFrame, column: str, as_of_year: int) -> DataFrame:
    """Add ``check`` and, for a valid threshold, its ISO timestamp."""
    iso = F.date_format(F.try_to_date(column, "yyyy-M-d"), "yyyy-MM-dd'T'HH:mm:ss")
    return df.withColumn("check", date_check(F.col(column), as_of_year)).withColumn(
        "threshold", F.when(F.col("check") == "ok", iso)
    )


def days_before(day: Column, days: Column) -> Column:
    return F.date_sub(day, days)
