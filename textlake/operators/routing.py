"""Message parsing, routing and dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.contract import add_contract, read_raw
from ..functions.quality import add_quality

#: Routes by what sends a row there, first match; a row that nothing holds back is processed.
HELD_BACK = {"contract_rejected": "NOT contract_valid", "quality_rejected": "quality_status = 'reject'", "quarantine": "quality_status = 'quarantine'"}
ROUTES = (*HELD_BACK, "processed")
#: Fields of a dead letter and what fills them (names are fixed values).
LETTER = {
    "contract_errors": "contract_errors",
    "raw_event": "_raw_json",
    "source_topic": "kafka_topic",
    "source_partition": "kafka_partition",
    "source_offset": "kafka_offset",
    "rejected_at": "date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
}


def parse_messages(messages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Messages (key, value, topic, partition, offset, timestamp) as raw events; the envelope's columns get the prefix kafka_, those of ``carry`` keep their names."""
    envelope = {c: f"kafka_{c}" for c in messages.columns if c in ("key", "topic", "partition", "offset", "timestamp")}
    texts = {c: F.col(c).cast("string") for c in ("key", "value")}
    return read_raw(messages.withColumns(texts).select("value", *envelope, *carry).withColumnsRenamed(envelope), "value")


def add_route(events: DataFrame) -> DataFrame:
    """``events`` with output_route, by the first entry of HELD_BACK that holds."""
    held = [F.when(F.expr(test), F.lit(route)) for route, test in HELD_BACK.items()]
    return events.withColumn("output_route", F.coalesce(*held, F.lit(ROUTES[-1])))


def transform(raw: DataFrame, strict: bool = False, when: str = "contract_valid") -> DataFrame:
    """Contract, then quality of the rows that keep it."""
    return add_quality(add_contract(raw, strict), when=when)


def split_valid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    return events.where("contract_valid"), events.where("NOT contract_valid")


def letter(reason: str = "CONTRACT_REJECTED") -> Column:
    """A rejected message's dead letter as JSON; rejected_at is the query's time."""
    return F.to_json(F.struct(F.lit(reason).alias("reason"), *[F.expr(what).alias(name) for name, what in LETTER.items()]))


def dead_letters(rejected: DataFrame, reason: str = "CONTRACT_REJECTED") -> DataFrame:
    """key ``topic:partition:offset`` and JSON value of rejected messages."""
    return rejected.select(message_key().alias("key"), letter(reason).alias("value"))


def message_key() -> Column:
    return F.format_string("%s:%d:%d", "kafka_topic", "kafka_partition", "kafka_offset")


def bounded(messages: DataFrame, ranges: DataFrame) -> DataFrame:
    """Messages within [start_offset, end_offset) of their topic and partition; ``ranges`` has a row a partition."""
    same = (messages["topic"] == ranges["topic"]) & (messages["partition"] == ranges["partition"])
    within = (messages["offset"] >= ranges["start_offset"]) & (messages["offset"] < ranges["end_offset"])
    return messages.join(ranges, same & within, "left_semi")


def of_run(events: DataFrame, run_id: str, analysis_date: str) -> DataFrame:
    """Events whose metadata names this run and date; rows without metadata aren't of it."""
    return events.where((F.col("metadata")["pipeline_run_id"] == run_id) & (F.col("metadata")["analysis_date"] == analysis_date))
