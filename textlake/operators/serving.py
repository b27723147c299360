"""The six serving queries, a snapshot and the latest ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

VERSIONS = ("v3", "v2", "v1", "all")
#: Columns that the two listings serve (fixed values).
BATCH = ("llm_batch_id", "status", "model", "requested_count", "completed_count", "failed_count", "input_tokens", "output_tokens", "total_cost_usd", "submitted_at", "completed_at")
ANALYSIS = ("event_id", "sentiment", "sentiment_score", "sentiment_distribution", "polarization", "polarization_score", "positive_tones", "negative_tones", "topics", "keywords", "summary", "model", "analyzed_at", "llm_batch_id")


def of_version(version: str, column: str = "prompt_version") -> Column:
    """Prompt versions that have ``version`` as a part between dashes; ``all`` takes every row."""
    if version not in VERSIONS:
        raise ValueError(f"version must be one of {VERSIONS}")
    return F.lit(True) if version == "all" else F.col(column).rlike(f"(^|-){version}($|-)")


def positive(limit: int) -> int:
    if limit < 1:
        raise ValueError("limits must be positive")
    return limit


def summary(analyses: DataFrame, version: str = "v3") -> DataFrame:
    rows = analyses.where(of_version(version))
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return rows.agg(
        F.count("*").alias("analysis_rows"),
        *[F.count_if(F.col("sentiment") == s).alias(f"{s}_rows") for s in ("positive", "neutral", "negative", "mixed")],
        mean("sentiment_score").alias("average_sentiment_score"),
        mean("polarization_score").alias("average_polarization_score"),
    )


def by_label(analyses: DataFrame, label: str, version: str = "v3", keep_null: bool = False) -> DataFrame:
    rows = analyses.where(of_version(version))
    rows = rows if keep_null else rows.where(F.col(label).isNotNull())
    return rows.groupBy(label).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), label)


def topics(analyses: DataFrame, version: str = "v3", limit: int = 15, fold: bool = False) -> DataFrame:
    """Most frequent topics, blank ones left out; ``fold`` trims them and puts them in lower case."""
    rows = analyses.where(of_version(version)).select(F.explode("topics").alias("topic")).where(F.trim("topic") != "")
    rows = rows.withColumn("topic", F.lower(F.trim("topic"))) if fold else rows
    return rows.groupBy("topic").agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), "topic").limit(positive(limit))


def batches(jobs: DataFrame, version: str = "v3", limit: int = 50) -> DataFrame:
    """Columns of BATCH of the jobs that ended, were sent or were made last."""
    latest = F.coalesce("completed_at", "submitted_at", "created_at")
    return jobs.where(of_version(version)).orderBy(F.desc(latest), "llm_batch_id").limit(positive(limit)).select(*BATCH)


def analyses(rows: DataFrame, requests: DataFrame, version: str = "v3", limit: int = 50) -> DataFrame:
    """Columns of ANALYSIS of the latest analyses whose request is known."""
    joined = rows.where(of_version(version)).join(requests.select("custom_id", "llm_batch_id"), "custom_id")
    return joined.orderBy(F.desc("analyzed_at"), "event_id").limit(positive(limit)).select(*ANALYSIS)


def snapshot(run_id: str, accounts: DataFrame, summary_row: DataFrame, created_at: str) -> DataFrame:
    """One nested row for a run; reading it fails if the accounted rows aren't the input."""
    ok = F.col("input_rows") == F.col("unique_rows") + F.col("duplicate_rows") + F.col("rejected_rows")
    return accounts.where(F.assert_true(ok, "input isn't accounted for").isNull()).join(F.broadcast(summary_row), F.lit(True)).select(  # one row each
        F.lit(run_id).alias("run_id"), F.lit(created_at).alias("created_at"), F.struct(*accounts.columns).alias("accounting"), F.struct(*summary_row.columns).alias("summary")
    )


def latest(snapshots: DataFrame, n: int) -> DataFrame:
    return snapshots.orderBy(F.desc("created_at"), "run_id").limit(positive(n))
