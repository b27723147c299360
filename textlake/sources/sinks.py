"""Sinks: partitioned files whose writes can be repeated, and the paths of routes and batches."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.contract import add_contract, require_valid
from ..schemas import EVENT_FIELDS

log = logging.getLogger(__name__)

#: Columns that steps hand on to each other and no sink stores.
INTERNAL = ("_raw_json", "_json_keys", "_corrupt_record", "seen_at", "identity")


def public(events: DataFrame) -> DataFrame:
    return events.drop(*INTERNAL)


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite", compression: str = "zstd") -> None:
    """Parquet in folders by ``by``. Rows are rebalanced first, so files are even and a value with most rows has several."""
    whole = df.hint("rebalance", *by)
    whole.write.mode(mode).option("compression", compression).option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)


def write_counted(df: DataFrame, path: str, by: list[str], counts: Mapping[str, Column], mode: str = "overwrite", compression: str = "zstd") -> dict:
    """``write_partitioned`` that also tells ``counts`` (aggregates) of what it wrote, observed in the pass that writes.

    They are observed behind the shuffle, in the tasks whose output is committed, so a task that runs
    again for a lost executor counts once. Nothing is read back.
    """
    seen = Observation()
    whole = df.hint("rebalance", *by).observe(seen, *[c.alias(n) for n, c in counts.items()])
    whole.write.mode(mode).option("compression", compression).option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)
    return seen.get


def write_days(df: DataFrame, path: str, by: tuple[str, ...] = ("year", "month", "day")) -> None:
    """Replaces the days that ``df`` has rows of and no others."""
    df.hint("rebalance", *by).write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_valid_json(events: DataFrame, path: str, strict: bool = True) -> None:
    """JSON lines of raw events (as ``read_raw`` gives them); the write fails, and leaves nothing committed, at one that breaks the contract."""
    write_json(require_valid(add_contract(events, strict)).select(*EVENT_FIELDS), path)


def write_or_fall_back(df: DataFrame, primary: str, fallback: str) -> str:
    """Appends ``df`` as JSON to ``primary``, or to ``fallback`` where that fails; the path that took it.

    For reports and logs that must not stop the job which they tell of. A failed write commits nothing.
    """
    try:
        df.write.mode("append").json(primary)
        return primary
    except Exception as e:
        log.warning("%s wasn't written (%s), falling back", primary, e)
        df.write.mode("append").json(fallback)
        return fallback


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def scrub_nuls(df: DataFrame) -> DataFrame:
    """U+FFFD for NUL in every text, list of texts and map of texts."""
    clean = lambda c: F.replace(c, F.lit("\x00"), F.lit("�"))
    out = {}
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "string":
            out[name] = clean(c)
        elif kind == "array<string>":
            out[name] = F.transform(c, clean)
        elif kind == "map<string,string>":
            out[name] = F.transform_values(c, lambda k, v: clean(v))
    return df.withColumns(out) if out else df
