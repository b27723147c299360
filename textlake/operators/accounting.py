"""Row accounting in one pass: what came in is unique, duplicate or rejected, or the query fails."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def account(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: input_rows, rejected_rows, valid_rows, unique_rows, duplicate_rows, raw_bytes.

    Rows are first counted by key, which combines before the shuffle, then summed; input is not read twice.
    """
    raw = F.coalesce(F.octet_length("_raw_json"), F.lit(0)).cast("long")
    by_key = events.groupBy("contract_valid", F.when(F.col("contract_valid"), F.col(key)).alias("_k")).agg(F.count("*").alias("n"), F.sum(raw).alias("b"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    valid = F.col("contract_valid")
    return by_key.agg(
        total("n").alias("input_rows"),
        total(F.when(~valid, F.col("n"))).alias("rejected_rows"),
        total(F.when(valid, F.col("n"))).alias("valid_rows"),
        total(F.when(valid, 1)).alias("unique_rows"),
        total(F.when(valid, F.col("n") - 1)).alias("duplicate_rows"),
        total("b").alias("raw_bytes"),
    )


def checked(accounts: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """``accounts``; reading it fails if the parts don't sum to the input, or the input isn't ``expected_rows``."""
    ok = F.col("input_rows") == F.col("unique_rows") + F.col("duplicate_rows") + F.col("rejected_rows")
    if expected_rows is not None:
        ok &= F.col("input_rows") == expected_rows
    return accounts.where(F.assert_true(ok, "row accounting doesn't add up").isNull())


def length_summary(df: DataFrame, text: str = "text") -> DataFrame:
    """Least, largest and mean length and largest byte count; nulls over no rows."""
    return df.agg(F.min(F.length(text)).alias("min_chars"), F.max(F.length(text)).alias("max_chars"), F.round(F.avg(F.length(text)), 2).alias("avg_chars"), F.max(F.octet_length(text)).alias("max_bytes"))


def frequency(df: DataFrame, items: str, name: str) -> DataFrame:
    """Rows by item of the array column ``items``; null items and arrays count nowhere.

    The outer explode keeps the optimizer from testing the array's size below it, which would make
    the array twice.
    """
    return df.select(F.explode_outer(items).alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("row_count"))


def label_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("row_count"))


def finalization(events: DataFrame, sources: tuple[str, ...], key: str = "event_id", source: str = "source_name") -> DataFrame:
    """One row: input_rows, stored_rows, duplicate_rows and a column of rows for each of ``sources``, in one pass."""
    by_key = events.groupBy(key, source).agg(F.count("*").alias("n"))
    per = by_key.groupBy(key).agg(F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(F.col(source) == s, F.col("n"))), F.lit(0)).alias(s) for s in sources])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_rows")
    sums = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("input_rows"), F.count("*").alias("stored_rows"), *map(total, sources))
    return sums.withColumn("duplicate_rows", F.col("input_rows") - F.col("stored_rows"))
