"""Run logs and replays: order checks and pacing. A run or key with most rows is spread over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scans import with_previous


def sequence_faults(log: DataFrame, run: str, sequence: str, time: str, least_rows: int = 100_000) -> DataFrame:
    """Rows of a run log that skip or repeat a sequence number or go back in time."""
    rows = with_previous(log, [run], [sequence, time], last={"_s": F.col(sequence), "_t": F.col(time)}, least_rows=least_rows)
    fault = F.when(F.col(sequence) == F.col("_s"), "repeated").when(F.col(sequence) > F.col("_s") + 1, "skipped").when(F.col(time) < F.col("_t"), "time goes back")
    return rows.withColumn("fault", fault).where(F.col("fault").isNotNull()).drop("_s", "_t")


def replay_delays(events: DataFrame, keys: list[str], time: str, order: str, speed: float, most: float, least_rows: int = 100_000) -> DataFrame:
    """Seconds to wait before each event: its distance from the one before over ``speed``, at most ``most``."""
    rows = with_previous(events, keys, [time, order], last={"_t": F.col(time)}, least_rows=least_rows)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    apart = F.coalesce(micros(time) - micros("_t"), F.lit(0)) / 1_000_000
    return rows.withColumn("delay", F.least(F.greatest(apart, F.lit(0.0)) / speed, F.lit(most))).drop("_t")
