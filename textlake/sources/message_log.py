"""A message log in files: keyed messages with offsets by topic and partition, published and read like a broker's.

A topic is a folder. Publishing tasks write segments (Parquet files, one a log partition that a task has
rows of); the commit on the driver gives them their offsets, so tasks that fail or run twice leave
nothing that can be read. Readers take exact offset ranges, as a batch or a stream, and fail where
offsets that they need are gone. The folder has to be mounted on all machines.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

from ..schemas import MESSAGE
from .commits import CommitLog, local_path

NAME = "textlake_log"
#: Rows that a segment holds at most.
SEGMENT_ROWS = 1_000_000
_WRITTEN = "partition int, key binary, value binary, timestamp timestamp"


class Topic:
    """Segments and offsets of one topic below ``root``.

    Each commit holds what it added, and per partition the end offset after it and the first offset that is
    still there, so the newest commit alone tells a topic's range.
    """

    def __init__(self, root: str, name: str):
        self.name, self.folder = name, f"{local_path(root) or root}/{name}"
        self.log = CommitLog(self.folder)

    def range(self) -> tuple[dict[int, int], dict[int, int]]:
        """First and end offset of each partition."""
        return self.range_at(self.log.latest())

    def range_at(self, number: int) -> tuple[dict[int, int], dict[int, int]]:
        now = self.log.read(number) if number >= 0 else {"starts": {}, "ends": {}}
        return tuple({int(p): o for p, o in now[k].items()} for k in ("starts", "ends"))

    def append(self, segments: list[dict], writer: str, batch: int) -> bool:
        """Gives ``segments`` (partition, file, rows) the next offsets, in one commit; False if ``writer`` has committed ``batch`` before."""
        while True:
            number = self.log.latest()
            now = self.log.read(number) if number >= 0 else {"starts": {}, "ends": {}, "batches": {}}
            if now["batches"].get(writer, -1) >= batch:
                return False
            ends, placed = dict(now["ends"]), []
            for s in segments:
                p = str(s["partition"])
                placed.append(s | {"base": ends.get(p, 0)})
                ends[p] = ends.get(p, 0) + s["rows"]
            starts = {p: now["starts"].get(p, 0) for p in ends}
            if self.log.add(number + 1, {"segments": placed, "starts": starts, "ends": ends, "batches": now["batches"] | {writer: batch}}):
                return True

    def trim(self, before: dict[int, int]) -> None:
        """Gives up the offsets below ``before`` of each partition; readers that ask for them fail from then on. Files stay until ``clean``."""
        while True:
            number = self.log.latest()
            now = self.log.read(number)
            starts = {p: max(o, min(before.get(int(p), o), now["ends"][p])) for p, o in now["starts"].items()}
            if self.log.add(number + 1, now | {"segments": [], "starts": starts}):
                return

    def segments(self, start: dict[int, int], end: dict[int, int]) -> Iterator[dict]:
        """Segments that hold offsets in [start, end), oldest first, each with the span wanted of it."""
        latest = self.log.latest()
        # ends only grow: the first commit whose ends pass a start has the first segment that is needed
        low, high = 0, latest + 1
        while low < high:
            middle = (low + high) // 2
            ends = self.range_at(middle)[1]
            if any(ends.get(p, 0) > o for p, o in start.items() if end.get(p, 0) > o):
                high = middle
            else:
                low = middle + 1
        for number in range(low, latest + 1):
            commit = self.log.read(number)
            for s in commit["segments"]:
                p, base = s["partition"], s["base"]
                a, b = max(base, start.get(p, 0)), min(base + s["rows"], end.get(p, 0))
                if a < b:
                    yield s | {"from": a, "to": b, "topic": self.name}
            if all(commit["ends"].get(str(p), 0) >= o for p, o in end.items()):
                return

    def clean(self) -> list[str]:
        """Removes segment files that no commit names (of failed tasks) or whose offsets are given up. Only while nothing publishes."""
        latest, alive = self.log.latest(), set()
        starts = self.range()[0]
        for number in range(latest + 1):
            alive |= {s["file"] for s in self.log.read(number)["segments"] if s["base"] + s["rows"] > starts[s["partition"]]}
        data = f"{self.folder}/data"
        gone = [f for f in sorted(os.listdir(data) if os.path.isdir(data) else []) if f not in alive]
        for f in gone:
            os.unlink(f"{data}/{f}")
        return gone


@dataclass
class Span(InputPartition):
    """Offsets [first, end) of one segment."""

    file: str
    topic: str
    partition: int
    base: int
    first: int
    end: int


class Offsets:
    """The options of a reader and offsets as JSON: {topic: {partition: offset}}."""

    def __init__(self, options):
        self.root = options["path"]
        self.topics = {t: Topic(self.root, t) for t in options["subscribe"].split(",")}
        self.limit = int(options.get("maxOffsetsPerTrigger", 0))
        self.keep_going = options.get("failOnDataLoss", "true").lower() == "false"

    def ends(self) -> dict:
        return {t: {str(p): o for p, o in x.range()[1].items()} for t, x in self.topics.items()}

    def starts(self) -> dict:
        return {t: {str(p): o for p, o in x.range()[0].items()} for t, x in self.topics.items()}

    def resolve(self, wanted: str) -> dict:
        """``earliest``, ``latest`` or JSON, in which -2 is the earliest and -1 the latest offset; partitions that JSON leaves out start at the earliest."""
        if wanted == "latest":
            return self.ends()
        first = self.starts()
        if wanted == "earliest":
            return first
        ends = self.ends()
        named = {t: {str(p): {-2: first[t].get(str(p), 0), -1: ends[t].get(str(p), 0)}.get(o, o) for p, o in x.items()} for t, x in json.loads(wanted).items() if t in self.topics}
        return {t: first[t] | named.get(t, {}) for t in self.topics}

    def limited(self, start: dict, end: dict) -> dict:
        """``end``, or as far as the limit of rows a batch goes, shared by partitions as they have rows."""
        left = {(t, p): o - start.get(t, {}).get(p, 0) for t, x in end.items() for p, o in x.items()}
        total = sum(left.values())
        if not self.limit or total <= self.limit:
            return end
        share = lambda n: max(1, n * self.limit // total) if n else 0
        return {t: {p: o - left[t, p] + share(left[t, p]) for p, o in x.items()} for t, x in end.items()}

    def spans(self, start: dict, end: dict) -> list[Span]:
        out = []
        for t, topic in self.topics.items():
            first, last = topic.range()
            a = {int(p): o for p, o in start.get(t, {}).items()}
            b = {int(p): o for p, o in end.get(t, {}).items()}
            a |= {p: first.get(p, 0) for p in b if p not in a}
            lost = {p: (a[p], first.get(p, 0)) for p in b if b[p] > a[p] and a[p] < first.get(p, 0)}
            beyond = {p: (b[p], last.get(p, 0)) for p in b if b[p] > max(a[p], last.get(p, 0))}
            if (lost or beyond) and not self.keep_going:
                raise RuntimeError(f"topic {t}: offsets are gone (partition: wanted, there): {lost | beyond}")
            a |= {p: there for p, (_, there) in lost.items()}
            out += [Span(f"{topic.folder}/data/{s['file']}", t, s["partition"], s["base"], s["from"], s["to"]) for s in topic.segments(a, b)]
        return out


def read_span(span: Span) -> Iterator[pa.RecordBatch]:
    """Record batches in the message schema; a few thousand rows of a segment at a time."""
    at = span.base
    for b in pq.ParquetFile(span.file).iter_batches(4096):
        low, high = max(0, span.first - at), min(b.num_rows, span.end - at)
        if low < high:
            part, n = b.slice(low, high - low), high - low
            offsets = pa.array(range(at + low, at + high), pa.int64())
            yield pa.RecordBatch.from_arrays([part["key"], part["value"], pa.array([span.topic] * n), pa.array([span.partition] * n, pa.int32()), offsets, part["timestamp"]], names=["key", "value", "topic", "partition", "offset", "timestamp"])
        at += b.num_rows
        if at >= span.end:
            return


class LogReader(DataSourceReader):
    def __init__(self, options):
        at = Offsets(options)
        self.found = at.spans(at.resolve(options.get("startingOffsets", "earliest")), at.resolve(options.get("endingOffsets", "latest")))

    def partitions(self) -> list[Span]:
        return self.found or [Span("", "", 0, 0, 0, 0)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return read_span(partition) if partition.file else iter(())


class LogStreamReader(DataSourceStreamReader):
    """The limit of rows a batch counts from where the stream stands; at a restart Spark tells that by planning the
    last batch again. Triggers that take what is available ask for its end once, so for them it is the run's limit."""

    def __init__(self, options):
        self.offsets, self.wanted, self.at = Offsets(options), options.get("startingOffsets", "earliest"), None

    def initialOffset(self) -> dict:
        self.at = self.at or self.offsets.resolve(self.wanted)
        return self.at

    def latestOffset(self) -> dict:
        return self.offsets.limited(self.initialOffset(), self.offsets.ends())

    def partitions(self, start: dict, end: dict) -> list[Span]:
        self.at = end
        return self.offsets.spans(start, end)

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return read_span(partition)


@dataclass
class Written(WriterCommitMessage):
    """Segments that a task wrote: partition, file and rows of each."""

    segments: list


class LogWriter(DataSourceArrowWriter, DataSourceStreamArrowWriter):
    """Publishes rows with partition, key, value and timestamp.

    ``writer`` names the publisher; of one publisher a batch number counts once. A batch write without a
    name publishes each time.
    """

    def __init__(self, options):
        self.topic = Topic(options["path"], options["topic"])
        self.writer, self.number = options.get("writer", uuid.uuid4().hex), int(options.get("batch", 0))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder, opened, done = f"{self.topic.folder}/data", {}, []
        os.makedirs(folder, exist_ok=True)

        def close(p: int) -> None:
            name, file, rows = opened.pop(p)
            file.close()
            done.append({"partition": p, "file": name, "rows": rows})

        for batch in iterator:
            rows = pa.Table.from_batches([batch]).combine_chunks()
            for p in pc.unique(rows["partition"]).to_pylist():
                part = rows.filter(pc.equal(rows["partition"], p)).drop_columns(["partition"])
                if p not in opened:
                    name = f"{p:06d}-{uuid.uuid4().hex}.parquet"
                    opened[p] = [name, pq.ParquetWriter(f"{folder}/{name}", part.schema, compression="zstd"), 0]
                opened[p][1].write_table(part)
                opened[p][2] += part.num_rows
                if opened[p][2] >= SEGMENT_ROWS:
                    close(p)
        for p in sorted(opened):
            close(p)
        return Written(done)

    def _commit(self, messages: list, batch: int) -> None:
        segments = [s for m in messages if m is not None for s in m.segments]
        if not self.topic.append(segments, self.writer, batch):
            self._abort(messages)

    def _abort(self, messages: list) -> None:
        for s in (s for m in messages if m is not None for s in m.segments):
            if os.path.exists(f := f"{self.topic.folder}/data/{s['file']}"):
                os.unlink(f)

    def commit(self, messages: list, batchId: int | None = None) -> None:
        self._commit(messages, self.number if batchId is None else batchId)

    def abort(self, messages: list, batchId: int | None = None) -> None:
        self._abort(messages)


class MessageLog(DataSource):
    """Options: path; to read subscribe (topics), startingOffsets, endingOffsets (batch), maxOffsetsPerTrigger
    (stream), failOnDataLoss; to write topic, writer, batch."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema) -> LogReader:
        return LogReader(self.options)

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> LogWriter:
        if overwrite:
            raise ValueError("messages are only appended")
        return LogWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> LogWriter:
        return LogWriter(self.options)


def rows_to_publish(df: DataFrame, partitions: int, key: Column, value: Column, timestamp: Column | None = None) -> DataFrame:
    """``df`` as messages; a key's messages share a partition, those without a key spread by their value. Nothing is shuffled."""
    key, value = key.cast("string").cast("binary"), value.cast("string").cast("binary")
    place = F.pmod(F.xxhash64(F.coalesce(key, value)), F.lit(partitions)).cast("int")
    return df.select(place.alias("partition"), key.alias("key"), value.alias("value"), (F.current_timestamp() if timestamp is None else timestamp).cast("timestamp").alias("timestamp"))


def publish(messages: DataFrame, root: str, topic: str, writer: str | None = None, batch: int = 0) -> None:
    """Appends ``messages`` (of ``rows_to_publish``) to a topic in one commit: all are there when it returns, none if it fails.

    A named writer's batch counts once, so a job that is run again publishes nothing twice. Rows of a
    partition are in the order of the tasks.
    """
    messages.sparkSession.dataSource.register(MessageLog)
    w = messages.select("partition", "key", "value", "timestamp").write.format(NAME).option("path", root).option("topic", topic)
    (w.option("writer", writer).option("batch", batch) if writer else w).mode("append").save()


def publish_stream(messages: DataFrame, root: str, topic: str, checkpoint: str, writer: str):
    """A stream writer that appends each batch in one commit, once."""
    messages.sparkSession.dataSource.register(MessageLog)
    rows = messages.select("partition", "key", "value", "timestamp")
    return rows.writeStream.format(NAME).option("path", root).option("topic", topic).option("writer", writer).option("checkpointLocation", checkpoint)


def read_range(spark: SparkSession, root: str, topics: str, start: str = "earliest", end: str = "latest") -> DataFrame:
    """Messages in exactly [start, end), offsets as JSON by topic and partition."""
    spark.dataSource.register(MessageLog)
    return spark.read.format(NAME).option("path", root).option("subscribe", topics).option("startingOffsets", start).option("endingOffsets", end).load()


def read_stream(spark: SparkSession, root: str, topics: str, start: str = "earliest", limit: int | None = None) -> DataFrame:
    spark.dataSource.register(MessageLog)
    r = spark.readStream.format(NAME).option("path", root).option("subscribe", topics).option("startingOffsets", start)
    return (r.option("maxOffsetsPerTrigger", limit) if limit else r).load()
