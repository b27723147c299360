"""Collection windows: coverage of days, gaps, overlaps and cursors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scans import with_previous


def inside(t: Column, start: Column, end: Column) -> Column:
    return (t >= start) & (t < end)


def overlaps(windows: DataFrame, days: DataFrame) -> DataFrame:
    """Windows that overlap each day [day_start, day_end), cut to it. A window joins its days by date, so no cross join."""
    last = F.date_sub(F.to_date("window_end"), F.when(F.col("window_end") == F.to_date("window_end").cast("timestamp"), 1).otherwise(0))
    dated = windows.withColumn("day", F.explode(F.sequence(F.to_date("window_start"), F.greatest(last, F.to_date("window_start")))))
    j = dated.join(days, "day").where((F.col("window_start") < F.col("day_end")) & (F.col("window_end") > F.col("day_start")))
    return j.withColumns({"cut_start": F.greatest("window_start", "day_start"), "cut_end": F.least("window_end", "day_end")})


def gaps(windows: DataFrame, keys: Sequence[str], start: str = "window_start", end: str = "window_end", least_rows: int = 100_000) -> DataFrame:
    """Stretches between windows of the same keys that none covers; a key with most windows is spread over tasks."""
    g = with_previous(windows.select(*keys, start, end), keys, [start, end], most={"gap_start": F.col(end)}, least_rows=least_rows)
    return g.where(F.col("gap_start") < F.col(start)).select(*keys, "gap_start", F.col(start).alias("gap_end"))


def uncovered_days(windows: DataFrame, days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days that the windows of a key don't cover from start to end, with the reason."""
    cut = overlaps(windows, days)
    edges = cut.groupBy(*keys, "day", "day_start", "day_end").agg(F.min("cut_start").alias("a"), F.max("cut_end").alias("z"))
    holes = gaps(cut, [*keys, "day"], "cut_start", "cut_end").select(*keys, "day").distinct().withColumn("hole", F.lit(True))
    names = windows.select(*keys).distinct()
    every = names.join(F.broadcast(days), F.lit(True))  # the days of one report against each key
    j = every.join(edges.select(*keys, "day", "a", "z"), [*keys, "day"], "left").join(holes, [*keys, "day"], "left")
    reason = F.when(F.col("a").isNull(), "no window").when(F.col("a") > F.col("day_start"), "late start").when(F.col("z") < F.col("day_end"), "early end").when(F.col("hole"), "gap")
    return j.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*keys, "day", "reason")


def date_coverage(actual: DataFrame, first: str, last: str) -> DataFrame:
    """Expected dates that ``actual`` (day) lacks and dates it has beyond them."""
    want = actual.sparkSession.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day"))
    have = actual.select("day").distinct()
    missing = want.join(have, "day", "left_anti").withColumn("state", F.lit("missing"))
    return missing.unionByName(have.join(want, "day", "left_anti").withColumn("state", F.lit("unexpected")))


def effective_window(requests: DataFrame, cursors: DataFrame) -> DataFrame:
    """Requested windows begun at the source's cursor where that is earlier, and the cursor after them, which never moves back."""
    j = requests.join(cursors, "source", "left")
    return j.withColumns({"effective_start": F.least("window_start", "cursor"), "next_cursor": F.greatest("window_end", "cursor")})
