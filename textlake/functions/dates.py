"""Days in a local zone as columns: bounds in UTC, the day before a moment, runs of days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def local_day(t: Column, zone: str = "Asia/Seoul") -> Column:
    """The date of a UTC timestamp in ``zone``."""
    return F.to_date(F.from_utc_timestamp(t, zone))


def day_bounds(day: Column, zone: str = "Asia/Seoul") -> tuple[Column, Column]:
    """UTC start and end of a local day; the end is not part of it."""
    at = lambda d: F.to_utc_timestamp(d.cast("timestamp"), zone)
    return at(day), at(F.date_add(day, 1))


def epoch_bounds(first: Column, last: Column) -> tuple[Column, Column]:
    """[start, end) in epoch seconds of the UTC days from ``first`` to ``last``, both included."""
    return F.unix_date(first) * F.lit(86_400).cast("long"), (F.unix_date(last) + 1) * F.lit(86_400).cast("long")


def analysis_days(spark: SparkSession, interval_end: str, first: str | None = None, last: str | None = None, scheduled: bool = False, zone: str = "Asia/Seoul") -> DataFrame:
    """Days (day) to work on: the local day before ``interval_end``, or a backfill from ``first`` to ``last``.

    ``interval_end`` is an ISO time with a zone. A backfill needs both dates, in order; scheduled runs pass over them.
    """
    if bool(first) != bool(last):
        raise ValueError("first and last go together")
    if first and not scheduled:
        if date.fromisoformat(last) < date.fromisoformat(first):
            raise ValueError("last is before first")
        return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day"))
    if not (interval_end.endswith("Z") or interval_end[-6:-5] in ("+", "-")):
        raise ValueError("interval_end needs a zone")
    return spark.range(1).select(F.date_sub(local_day(F.to_timestamp(F.lit(interval_end)), zone), 1).alias("day"))
