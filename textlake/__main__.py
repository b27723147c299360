"""Command line: batch files, bounded and streaming messages, a message log, copies, archive days, output checks."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession, functions as F

from .operators import accounting, dedup, routing
from .session import build_session
from .sources import copies, events, message_log, sinks
from .streaming import consumer


def batch(spark: SparkSession, a: argparse.Namespace) -> dict:
    """JSON lines to unique valid events and rejected rows; the report's parts must sum to the input."""
    routed = routing.add_route(routing.transform(events.read_jsonl(spark, a.input)))
    report = accounting.checked(accounting.account(routed), a.expected_rows).first().asDict()
    unique = dedup.first_wins(routed.where("contract_valid"), ["event_id"], [F.col("collected_timestamp"), F.col("_raw_json")])
    sinks.write_partitioned(sinks.public(unique), f"{a.output}/valid", ["source_type"])
    sinks.write_json(routed.where("NOT contract_valid").select("contract_errors", "_raw_json"), f"{a.output}/rejected")
    return report


def bounded(spark: SparkSession, a: argparse.Namespace) -> dict:
    """One run's events from captured messages within exact offsets (JSON list of topic, partition, start, end)."""
    ranges = spark.createDataFrame([tuple(r) for r in json.loads(a.ranges)], "topic string, partition int, start_offset long, end_offset long")
    messages = spark.read.parquet(a.input)
    rows = consumer.bounded_batch(messages, ranges, a.run_id, a.analysis_date)
    sinks.write_partitioned(sinks.public(rows), a.output, ["source_type"])
    read = routing.bounded(messages, ranges).count()
    kept = spark.read.parquet(a.output).count()
    if a.expected_rows is not None and kept != a.expected_rows:
        raise SystemExit(f"expected {a.expected_rows} rows of the run, found {kept}")
    return {"read_rows": read, "run_rows": kept, "foreign_rows": read - kept}


def stream(spark: SparkSession, a: argparse.Namespace) -> dict:
    c = consumer.ConsumerConfig(a.topic, a.dead_letter_topic, a.output, a.checkpoint, a.starting_offsets, a.max_offsets, a.watermark, a.interval, a.name, a.account_all)
    source = consumer.kafka_messages(spark, a.servers, c) if a.servers else consumer.log_messages(spark, a.log, c) if a.log else consumer.file_messages(spark, a.input)
    query = consumer.start(source, c)
    query.awaitTermination()
    return {"batches": (query.lastProgress or {}).get("batchId", -1) + 1}


def publish(spark: SparkSession, a: argparse.Namespace) -> dict:
    """JSON lines of events to a message log, keyed by event id, in one commit; a named writer publishes once."""
    lines = spark.read.text(a.input).where(F.trim("value") != "")
    rows = message_log.rows_to_publish(lines, a.partitions, F.get_json_object("value", "$.event_id"), F.col("value"))
    message_log.publish(rows, a.log, a.topic, a.writer)
    return {"offsets": message_log.Topic(a.log, a.topic).range()[1]}


def copy(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Files to another store, each verified."""
    return {r.status: r["count"] for r in copies.copy_verified(spark, a.input, a.output).groupBy("status").count().collect()}


def archive(spark: SparkSession, a: argparse.Namespace) -> dict:
    names = [r.name for r in events.allowlist(spark, a.names).collect()]  # a file written by people
    rows = events.archive_days(events.require_columns(spark.read.parquet(a.input)), names)
    sinks.write_days(rows, a.output)
    return events.list_files(spark, a.output).first().asDict()


def verify(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Distinct ids and rows over the routes below a consumer's output; they must agree."""
    r = consumer.read_written(spark, a.output, "processed", "event_id string").agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("ids")).first()
    if r.rows != r.ids:
        raise SystemExit(f"{r.rows} processed rows have {r.ids} ids")
    return r.asDict()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="textlake")
    sub = p.add_subparsers(required=True)

    def command(command_name, run, **options):
        s = sub.add_parser(command_name, help=(run.__doc__ or "").split("\n")[0])
        for k, v in options.items():
            s.add_argument(f"--{k.replace('_', '-')}", **v)
        s.set_defaults(run=run)

    need, number = {"required": True}, {"type": int}
    command("batch", batch, input=need, output=need, expected_rows=number)
    command("bounded", bounded, input=need, output=need, ranges=need, run_id=need, analysis_date=need, expected_rows=number)
    command("stream", stream, input={}, servers={}, log={}, account_all={"action": "store_true"}, topic={"default": "events"}, dead_letter_topic={"default": "events-dead"}, output=need, checkpoint=need, starting_offsets={"default": "earliest"}, max_offsets=number, watermark={"default": "10 minutes"}, interval={}, name={"default": "consumer"})
    command("publish", publish, input=need, log=need, topic={"default": "events"}, partitions=number | {"default": 8}, writer={})
    command("copy", copy, input=need, output=need)
    command("archive", archive, input=need, output=need, names=need)
    command("verify", verify, output=need)
    a = p.parse_args(argv)
    print(json.dumps(a.run(build_session("textlake"), a), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
