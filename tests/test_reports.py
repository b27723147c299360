"""Result schemas, reports, offsets, feeds and validated writes in cases that the queries' tables don't have."""

import json
import os

import pytest
from pyspark.sql import functions as F

from textlake.functions import analysis as A
from textlake.operators import groups, reconcile
from textlake.sources import events as S
from textlake.sources import sinks

TONE = {"tone": "hope", "share": 1.0, "drivers": ["jobs"]}
GOOD = {
    "estimated_sentiment_distribution": {"positive": 0.5, "neutral": 0.25, "negative": 0.25},
    "polarization": "low",
    "polarization_score": 0,
    "topics": ["economy"],
    "keywords": [],
    "summary": "s" * 400,
    "positive_tones": [TONE],
    "negative_tones": [],
}
CASES = [
    ({}, []),
    ({"topics": ["t" * 80] * 5, "keywords": ["k" * 60] * 8, "polarization_score": 1}, []),
    ({"topics": ["t"] * 6}, ["topics"]),
    ({"topics": ["t" * 81]}, ["topics"]),
    ({"topics": [""]}, ["topics"]),
    ({"topics": "economy"}, ["topics"]),
    ({"keywords": ["k"] * 9}, ["keywords"]),
    ({"keywords": ["k" * 61]}, ["keywords"]),
    ({"keywords": None}, ["keywords"]),
    ({"summary": ""}, ["summary"]),
    ({"summary": "s" * 401}, ["summary"]),
    ({"polarization": "extreme"}, ["polarization"]),
    ({"polarization_score": 1.01}, ["polarization_score"]),
    ({"polarization_score": -0.1}, ["polarization_score"]),
    ({"mood": 1}, ["unknown_fields"]),
    ({"estimated_sentiment_distribution": {"positive": 0.5, "neutral": 0.5}}, ["estimated_sentiment_distribution"]),
    ({"estimated_sentiment_distribution": {"positive": 2, "neutral": 0, "negative": 0}}, ["estimated_sentiment_distribution"]),
    ({"estimated_sentiment_distribution": {"positive": 1, "neutral": 0, "negative": 0, "mixed": 0}}, ["estimated_sentiment_distribution"]),
    ({"positive_tones": [TONE] * 4}, []),
    ({"positive_tones": [TONE] * 5}, ["positive_tones"]),
    ({"positive_tones": [TONE | {"tone": "anger"}]}, ["positive_tones"]),
    ({"negative_tones": [TONE | {"tone": "anger"}]}, []),
    ({"negative_tones": [TONE]}, ["negative_tones"]),
    ({"positive_tones": [TONE | {"share": 1.1}]}, ["positive_tones"]),
    ({"positive_tones": [TONE | {"drivers": []}]}, ["positive_tones"]),
    ({"positive_tones": [TONE | {"drivers": ["d"] * 5}]}, ["positive_tones"]),
    ({"positive_tones": [TONE | {"drivers": ["d" * 81]}]}, ["positive_tones"]),
    ({"positive_tones": [TONE | {"note": 1}]}, ["positive_tones"]),
    ({"positive_tones": [{"tone": "hope", "share": 1.0}]}, ["positive_tones"]),
]


def test_schema_rules(spark):
    missing = {k: v for k, v in GOOD.items() if k != "summary"}
    rows = [(json.dumps(GOOD | change), want) for change, want in CASES] + [(json.dumps(missing), ["missing_fields", "summary"]), ("[1]", None), ("{", None), (None, None)]
    out = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(rows)], "i int, raw string").select("i", A.schema_errors(F.col("raw")).alias("e")).collect()
    for r in out:
        assert r.e == rows[r.i][1] if rows[r.i][1] is not None else r.e[:2] == ["not_an_object", "missing_fields"], rows[r.i]


def test_top_tones(spark):
    tones = [("a", 0.1, []), ("b", 0.5, []), ("c", 0.5, []), ("d", None, []), ("e", 0.2, [])]
    df = spark.createDataFrame([(1, tones), (2, None), (3, [])], "i int, t array<struct<tone:string,share:double,drivers:array<string>>>")
    assert {r.i: [x.tone for x in r.t] for r in df.select("i", A.top_tones(F.col("t")).alias("t")).collect()} == {1: ["b", "c", "e"], 2: [], 3: []}


def test_every_result_and_request_is_consumed(spark):
    asked, got = spark.createDataFrame([("d1", "a"), ("d2", "b")], "day string, custom_id string"), spark.createDataFrame([("a", 1), ("b", 2)], "custom_id string, v int")
    assert sorted((r.day, r.v) for r in reconcile.day_results(asked, got).collect()) == [("d1", 1), ("d2", 2)]
    with pytest.raises(Exception, match="result without a manifest: b"):
        reconcile.day_results(asked.limit(1), got).collect()
    with pytest.raises(Exception, match="no result for"):
        reconcile.day_results(asked, got.where("v = 1")).collect()


def test_offset_spans(spark):
    at = lambda *rows: spark.createDataFrame(rows, "topic string, partition int, offset long")
    assert [r.span for r in reconcile.offset_span(at(("t", 0, 3), ("t", 1, 5)), at(("t", 0, 9), ("t", 1, 5))).collect()] == [6]
    with pytest.raises(Exception, match=r"partitions differ: t\[1\]"):
        reconcile.offset_span(at(("t", 0, 3), ("t", 1, 5)), at(("t", 0, 9))).collect()
    with pytest.raises(Exception, match="the end is before the start"):
        reconcile.offset_span(at(("t", 0, 3)), at(("t", 0, 2))).collect()


def test_batch_context(spark):
    m = spark.createDataFrame([("b", "2024-01-02", "g"), ("b", " ", "h"), ("b", "2024-01-01", None), ("c", None, None), ("d", "2024-01-05", "g")], "llm_batch_id string, period string, group_name string")
    got = {r.llm_batch_id: (r.period, r.groups) for r in reconcile.batch_context(m, {"g": "Group"}).collect()}
    assert got == {"b": ("2024-01-01 ~ 2024-01-02", "Group, h"), "c": (None, ""), "d": ("2024-01-05", "Group")}


def test_daily_report_of_no_days(spark):
    none = spark.createDataFrame([], "day date, status string, validated_rows long, failed_rows long, input_tokens long, output_tokens long, cached_input_tokens long, reasoning_output_tokens long, cost_usd decimal(18,6)")
    r = reconcile.daily_report(none, "2024-01-01", "2024-01-31").first()
    assert (r.requested_days, r.completed_days, r.pending_days, r.validated_rows, r.cost_usd) == (31, 0, 31, 0, 0)


def test_validated_write(spark, tmp_path):
    good = {"event_id": "a" * 64, "source_type": "news", "source_name": "gdelt", "event_time": "2024-01-01T00:00:00Z", "collected_at": "2024-01-01T00:00:00Z", "language": "en", "title": None, "text": "t", "url": None, "community": None, "engagement": 3, "schema_version": 1, "metadata": {"k": "v"}}
    raw = lambda *events: S.read_raw(spark.createDataFrame([(json.dumps(e),) for e in events], "v string"), "v")
    sinks.write_valid_json(raw(good), f"file://{tmp_path}/ok")
    assert [(r.event_id, r.engagement, r.metadata) for r in S.read_json_glob(spark, f"{tmp_path}/ok").collect()] == [("a" * 64, 3, {"k": "v"})]
    with pytest.raises(Exception, match="INVALID_EVENT_ID"):
        sinks.write_valid_json(raw(good, good | {"event_id": "b"}), f"file://{tmp_path}/bad")
    assert not os.path.exists(tmp_path / "bad" / "_SUCCESS")


def test_group_configuration(spark, tmp_path):
    config = {"groups": {"g": {"label": "l", "news_topic": "t", "subreddits": ["News", "Science"]}, "h": {"news_topic": "u", "subreddits": []}}}
    (tmp_path / "g.json").write_text(json.dumps(config))
    want = [("g", "l", "t", ["news", "science"]), ("h", None, "u", [])]
    assert sorted(map(tuple, S.analysis_groups(spark, f"{tmp_path}/g.json").collect())) == want
    yaml = pytest.importorskip("yaml")
    (tmp_path / "g.yaml").write_text(yaml.safe_dump(config))
    assert sorted(map(tuple, S.analysis_groups(spark, f"{tmp_path}/g.yaml").collect())) == want


def test_prompt_lines(spark):
    rows = [(1, "d", "reddit", "B", "x\r\ny", None), (2, "d", "reddit", "a", "z", None), (3, "d", "web_news", None, "body", "T\nitle"), (4, "d", "reddit", "a", "[Removed]", None), (5, "e", "reddit", "a", "w" * 5000, None)]
    df = spark.createDataFrame(rows, "doc_id long, day string, source_name string, community string, text string, title string")
    got = sorted((r.doc_id, r.kind, r.line, r.place) for r in groups.prompt_lines(df).collect())
    assert got == [(1, "R", "R\tb\tx  y", 2), (2, "R", "R\ta\tz", 1), (3, "N", "N\tT itle", 1), (5, "R", "R\ta\t" + "w" * 5000, 1)]


def test_fallback_and_copy_states(spark, tmp_path):
    (tmp_path / "file").write_text("not a folder")
    df = spark.range(3)
    assert sinks.write_or_fall_back(df, f"file://{tmp_path}/one", f"file://{tmp_path}/two").endswith("one")
    assert sinks.write_or_fall_back(df, f"file://{tmp_path}/file/x", f"file://{tmp_path}/two").endswith("two")
    assert spark.read.json(f"{tmp_path}/two").count() == 3
    for at, text in (("a/x", "1"), ("a/s/y", "2"), ("b/x", "1"), ("b/s/y", "3")):
        (tmp_path / at).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / at).write_text(text)
    states = S.copy_states(S.file_digests(spark, f"file://{tmp_path}/a"), S.file_digests(spark, f"file://{tmp_path}/b"))
    assert {(r.name, r.state) for r in states.collect()} == {("x", "same"), ("s/y", "changed")}
    with pytest.raises(Exception, match="changed after the copy: s/y"):
        S.verified(states).collect()
