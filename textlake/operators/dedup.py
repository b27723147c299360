"""First-wins and latest-wins dedup, and merges that keep some columns from the first row and some from the last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scans import same


def _one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool) -> DataFrame:
    """A row a key by aggregation, which combines before the shuffle: a hot key is one row a task, never a window."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    row = F.struct(*[F.col(c) for c in df.columns])
    best = (F.max_by if last else F.min_by)(row, rank)
    return df.groupBy(*keys).agg(best.alias("_row")).select("_row.*")


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that is first by ``order``; nulls come first. Order must be total for a stable choice."""
    return _one(df, keys, order, last=False)


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return _one(df, keys, order, last=True)


def duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows that ``first_wins`` drops, by a total ``order``; rows that tie with the first are not among them.

    The first place of each key is an aggregate, and rows behind it are found by a join, which Spark
    can split where one key has most rows; no window sorts a key. Null keys are a key.
    """
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    least = df.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(F.min(rank).alias("_least"), F.count("*").alias("_n")).where("_n > 1")
    ranked = df.withColumn("_rank", rank)
    return ranked.join(least, same(ranked, least, names), "inner").where(F.col("_rank") > F.col("_least")).select(*df.columns)


def merge(df: DataFrame, keys: Sequence[str], order: Sequence[Column], first: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """A row a key: ``first`` columns of its first row and ``latest`` ones of its last, nulls included."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return df.groupBy(*keys).agg(*[F.min_by(c, rank).alias(c) for c in first], *[F.max_by(c, rank).alias(c) for c in latest])


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column], first: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """``stored`` with ``incoming`` merged in: stored rows rank before all incoming ones."""
    both = stored.withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    return merge(both, keys, [F.col("_side"), *order], first, latest)


def uncommitted(batches: DataFrame, ledger: DataFrame, keys: Sequence[str] = ("consumer_name", "batch_id")) -> DataFrame:
    """Rows whose batch the ledger doesn't have yet."""
    return batches.join(ledger, list(keys), "left_anti")
