import json
import os
from collections import Counter

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from textlake.schemas import EVENT_FIELDS
from textlake.sources import message_log as M
from textlake.sources.commits import CommitLog
from textlake.streaming import consumer as C


def event(i, time, text="Some words.", **fields):
    e = dict.fromkeys(EVENT_FIELDS) | {"event_id": f"{i:064x}", "source_type": "news", "source_name": "web_news", "event_time": time, "collected_at": time, "language": "en", "text": text, "schema_version": 1, "metadata": {"a": "b"}} | fields
    return json.dumps(e)


def put(spark, root, values, topic="ev", partitions=2, **kind):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k long, v string").coalesce(1).sortWithinPartitions("k")
    M.publish(M.rows_to_publish(df, partitions, F.col("k"), F.col("v"), F.lit("2024-01-01 00:00:00")), root, topic, **kind)


def routes(spark, root):
    return Counter(r.output_route for r in spark.read.parquet(f"{root}/out/events").select("output_route").collect())


def test_every_message_is_on_one_route_over_restarts(spark, tmp_path):
    root = f"file://{tmp_path}"
    c = C.ConsumerConfig("ev", "dead", f"{root}/out", f"{root}/check", watermark="10 minutes", account_all=True)
    run = lambda: C.start(C.log_messages(spark, f"{root}/log", c), c).awaitTermination()
    put(spark, f"{root}/log", [event(1, "2024-01-01T00:00:00Z"), event(2, "2024-01-01T02:00:00Z"), "not json", event(1, "2024-01-01T00:01:00Z"), event(3, "2024-01-01T02:01:00Z", "[removed]")])
    run()
    assert routes(spark, root) == {"processed": 2, "contract_rejected": 1, "duplicate": 1, "quality_rejected": 1}
    # watermark is 01:51 now: one late row whose event is known, one late new row, a repetition, a new event, a late broken one
    put(spark, f"{root}/log", [event(1, "2024-01-01T01:00:00Z"), event(4, "2024-01-01T01:50:59Z"), event(2, "2024-01-01T02:05:00Z"), event(5, "2024-01-01T05:00:00Z"), event(6, "2024-01-01T00:00:00Z", extra=1)])
    run()
    assert routes(spark, root) == {"processed": 3, "contract_rejected": 2, "duplicate": 2, "quality_rejected": 1, "late": 2}
    # watermark is 04:50: event 2 was known until 02:10, so it is new again; event 5 still known
    put(spark, f"{root}/log", [event(2, "2024-01-01T05:30:00Z"), event(5, "2024-01-01T04:50:00Z")])
    run()
    run()
    assert routes(spark, root) == {"processed": 4, "contract_rejected": 2, "duplicate": 3, "quality_rejected": 1, "late": 2}
    ledger = C.read_ledger(spark, f"{root}/out").agg(F.sum("row_count")).first()[0]
    assert ledger == 12 == M.read_range(spark, f"{root}/log", "ev").count()


def test_quality_is_judged_of_kept_rows_only(spark, tmp_path):
    root = f"file://{tmp_path}"
    c = C.ConsumerConfig("ev", "dead", f"{root}/out", f"{root}/check", account_all=True)
    put(spark, f"{root}/log", [event(1, "2024-01-01T00:00:00Z"), event(1, "2024-01-01T00:00:00Z", engagement=9007199254740993)])
    C.start(C.log_messages(spark, f"{root}/log", c), c).awaitTermination()
    rows = {r.output_route: r for r in spark.read.parquet(f"{root}/out/events").collect()}
    assert rows["processed"].quality_status == "accept" and rows["duplicate"].quality_status is None
    assert {rows["processed"].engagement, rows["duplicate"].engagement} == {None, 9007199254740993}


class Calls:
    """A state of one group and its timers, which count the calls."""

    def __init__(self):
        self.rows, self.calls, self.timers = [], 0, []

    def count(self, rows=None):
        self.calls += 1
        return rows

    get = lambda self: iter(self.count(self.rows))
    exists = lambda self: self.count(bool(self.rows))
    put = lambda self, rows: self.count(setattr(self, "rows", list(rows)))
    appendList = lambda self, rows: self.count(self.rows.extend(rows))
    clear = lambda self: self.count(self.rows.clear())
    update = lambda self, row: self.count(setattr(self, "rows", [row]))
    registerTimer = lambda self, at: self.count(self.timers.append(at))
    getListState = getValueState = lambda self, *_: self


class Clock:
    def __init__(self, watermark):
        self.getCurrentWatermarkInMs = lambda: watermark


def judged(state, watermark, *parts, delay=100):
    first = C.FirstSeen(delay)
    first.init(state)
    made = [pd.DataFrame([(e, ms, "t", "0", str(o), None) for e, ms, o in rows], columns=["event", "seen_ms", "topic", "partition", "offset", "clock"]) for rows in parts]
    return [list(x["verdict"]) for x in first.handleInputRows(("events 7",), iter(made), Clock(watermark))]


def test_first_message_of_an_event_is_kept_whichever_part_has_it():
    state = Calls()
    assert judged(state, 0, [("a", 50, 12), ("b", 60, 8)], [("a", 40, 9), ("a", 70, 30)], [("b", 60, 7)]) == [["duplicate", "duplicate"], ["first", "duplicate"], ["first"]]
    assert dict(state.rows) == {"a": 140, "b": 160}
    # a is no longer known, b is; c is late and leaves no trace
    assert judged(state, 150, [("a", 150, 40), ("b", 170, 41), ("c", 149, 42)]) == [["first", "duplicate", "late"]]
    assert dict(state.rows) == {"b": 160, "a": 250} and len(state.rows) == 2 and state.timers[-1] == 250
    first = C.FirstSeen(100)
    first.init(state)
    assert list(first.handleExpiredTimer(("events 7",), Clock(249), None)) == [] and dict(state.rows) == {"a": 250}
    assert list(first.handleExpiredTimer(("events 7",), Clock(250), None)) == [] and state.rows == []


def test_state_is_asked_by_group_not_by_event(monkeypatch):
    monkeypatch.setattr(C, "HELD", 1000)  # rows go to disk
    state, rows = Calls(), [(f"e{i}", i, i) for i in range(5000)]
    assert judged(state, 0, rows[:2500], rows[2500:] + rows[:10]) == [["first"] * 2500, ["first"] * 2500 + ["duplicate"] * 10]
    assert len(state.rows) == 5000 and state.calls <= 5


def test_offsets_advance_by_the_limit_and_replay_exactly(spark, tmp_path):
    root, got = f"file://{tmp_path}", []
    put(spark, f"{root}/log", [str(i) for i in range(100)], partitions=3)

    def consume(times):
        each = lambda df, n: got.append((n, [(r.partition, r.offset) for r in df.collect()]))
        q = M.read_stream(spark, f"{root}/log", "ev", limit=40).writeStream.option("checkpointLocation", f"{root}/check").foreachBatch(each).trigger(processingTime="0 seconds").start()
        q.processAllAvailable()
        q.stop()

    consume(1)
    assert [len(x) for _, x in got] and all(len(x) <= 42 for _, x in got) and len(got) >= 3
    put(spark, f"{root}/log", [str(i) for i in range(30)], partitions=3)
    consume(2)
    places = [p for _, x in got for p in x]
    assert len(places) == len(set(places)) == 130


def test_bounded_ranges_and_lost_offsets(spark, tmp_path):
    root = f"file://{tmp_path}/log"
    put(spark, root, [f"a{i}" for i in range(50)], partitions=2)
    put(spark, root, [f"b{i}" for i in range(50)], partitions=2)
    topic = M.Topic(root, "ev")
    starts, ends = topic.range()
    assert sum(ends.values()) == 100 and set(starts.values()) == {0}
    exact = M.read_range(spark, root, "ev", json.dumps({"ev": {"0": 3, "1": -1}}), json.dumps({"ev": {"0": ends[0] - 2, "1": -1}}))
    assert sorted((r.partition, r.offset) for r in exact.collect()) == [(0, o) for o in range(3, ends[0] - 2)]
    assert M.read_range(spark, root, "ev", "latest").count() == 0
    with pytest.raises(Exception, match="offsets are gone"):
        M.read_range(spark, root, "ev", "earliest", json.dumps({"ev": {"0": ends[0] + 5}})).count()
    topic.trim({0: 30})
    assert topic.range()[0] == {0: min(30, ends[0]), 1: 0}
    with pytest.raises(Exception, match="offsets are gone"):
        M.read_range(spark, root, "ev", json.dumps({"ev": {"0": 3}})).count()
    assert M.read_range(spark, root, "ev").where("partition = 0").agg(F.min("offset")).first()[0] == min(30, ends[0])
    before = set(os.listdir(f"{tmp_path}/log/ev/data"))
    gone = topic.clean()
    assert gone and set(gone) < before and M.read_range(spark, root, "ev").where("partition = 1").count() == ends[1]


def test_publishing_twice_or_failing_leaves_no_duplicate(spark, tmp_path):
    root = f"file://{tmp_path}/log"
    for _ in range(2):
        put(spark, root, ["a", "b", "c"], writer="job", batch=4)
    assert M.read_range(spark, root, "ev").count() == 3
    put(spark, root, ["d"], writer="job", batch=5)
    bad = M.rows_to_publish(spark.range(0, 40, 1, 4), 2, F.col("id"), F.expr("IF(id = 33, raise_error('lost'), 'x')"))
    with pytest.raises(Exception, match="lost"):
        M.publish(bad, root, "ev")
    assert sorted(bytes(r.value).decode() for r in M.read_range(spark, root, "ev").collect()) == ["a", "b", "c", "d"]
    M.Topic(root, "ev").clean()
    alive = sum(pq.ParquetFile(f"{tmp_path}/log/ev/data/{f}").metadata.num_rows for f in os.listdir(f"{tmp_path}/log/ev/data"))
    assert alive == 4


def test_a_key_keeps_its_partition_and_order(spark, tmp_path):
    root = f"file://{tmp_path}/log"
    df = spark.range(0, 300, 1, 3)
    M.publish(M.rows_to_publish(df, 4, F.col("id") % 7, F.col("id")), root, "ev")
    by = {}
    for r in sorted(M.read_range(spark, root, "ev").collect(), key=lambda r: r.offset):
        by.setdefault(bytes(r.key), []).append((r.partition, int(bytes(r.value))))
    assert len(by) == 7
    for rows in by.values():
        assert len({p for p, _ in rows}) == 1 and [v for _, v in rows] == sorted(v for _, v in rows)


def test_stream_to_stream(spark, tmp_path):
    """A stream's batches are published once each, over a restart."""
    root = f"file://{tmp_path}"
    for k in range(2):
        put(spark, f"{root}/log", [f"{k}-{i}" for i in range(20)])
        copy = M.read_stream(spark, f"{root}/log", "ev").select(F.col("partition"), "key", "value", "timestamp")
        M.publish_stream(copy, f"{root}/log", "copy", f"{root}/check", "copier").trigger(availableNow=True).start().awaitTermination()
    assert sorted(bytes(r.value) for r in M.read_range(spark, f"{root}/log", "copy").collect()) == sorted(bytes(r.value) for r in M.read_range(spark, f"{root}/log", "ev").collect())
    assert M.read_range(spark, f"{root}/log", "ev,copy").groupBy("topic").count().collect() in ([("ev", 40), ("copy", 40)], [("copy", 40), ("ev", 40)])


def test_commits_by_compare_and_set(tmp_path):
    a, b = CommitLog(f"file://{tmp_path}"), CommitLog(str(tmp_path))
    assert a.latest() == -1
    assert a.add(0, {"x": 1}) and not b.add(0, {"x": 2})
    assert b.add(1, {"x": 3}) and a.latest() == 1 and [a.read(i)["x"] for i in range(2)] == [1, 3]
    assert sorted(os.listdir(f"{tmp_path}/_log")) == [f"{i:020d}.json" for i in range(2)]
    with pytest.raises(ValueError, match="mounted"):
        CommitLog("hdfs://far/away")


def test_concurrent_publishers_share_no_offset(tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def one(k):
        return M.Topic(str(tmp_path), "ev").append([{"partition": 0, "file": f"{k}", "rows": k + 1}], f"w{k}", 0)

    with ThreadPoolExecutor(8) as pool:
        assert all(pool.map(one, range(30)))
    placed = sorted((s["base"], s["rows"]) for n in range(30) for s in CommitLog(f"{tmp_path}/ev").read(n)["segments"])
    assert [b for b, _ in placed] == [sum(r for _, r in placed[:i]) for i in range(30)]


def test_counts_come_from_the_writing_pass(spark, tmp_path):
    """Counts equal what lies in the files, and the write is one job over one scan."""
    from textlake.sources import sinks

    spark.range(0, 5000, 1, 7).selectExpr("id", "id % 3 AS g", "repeat('x', 10) AS t").write.parquet(f"file://{tmp_path}/in")
    df = spark.read.parquet(f"file://{tmp_path}/in")
    counts = {"rows": F.count("*"), "first": F.count_if(F.col("g") == 0), "bytes": F.sum(F.octet_length("t")), "least": F.min("id")}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "one write")
    told = sinks.write_counted(df, f"file://{tmp_path}/out", ["g"], counts)
    jobs = tracker.getJobIdsForGroup("counted")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert told == {"rows": 5000, "first": 1667, "bytes": 50_000, "least": 0}
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 5000
    assert len(jobs) <= 2  # the shuffle's map side and the write, as AQE submits them
    again = sinks.write_counted(df.limit(0), f"file://{tmp_path}/none", ["g"], {"rows": F.count("*")})
    assert again == {"rows": 0}


def test_a_consumer_on_an_interval_takes_the_log_in_steps(spark, tmp_path):
    """processingTime with a limit of messages a batch: several batches, all messages, then a restart that has nothing to do."""
    root = f"file://{tmp_path}"
    c = C.ConsumerConfig("ev", "dead", f"{root}/out", f"{root}/check", interval="1 second", max_offsets_per_trigger=10)
    put(spark, f"{root}/log", [event(i, f"2024-01-01T00:{i:02d}:00Z") for i in range(25)])
    for _ in range(2):
        query = C.start(C.log_messages(spark, f"{root}/log", c), c)
        query.processAllAvailable()
        query.stop()
        ledger = C.read_ledger(spark, f"{root}/out").collect()
        assert sum(r.row_count for r in ledger) == 25 and sum(r.row_count > 0 for r in ledger) >= 3
