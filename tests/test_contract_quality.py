import json
import random
import unicodedata
import zlib

import pytest
from pyspark.sql import functions as F

from textlake.functions import quality
from textlake.functions.contract import add_contract, read_raw, require_valid, rules
from textlake.operators import accounting, dedup, routing
from textlake.plans import registry, views
from textlake.sources import events as S

GOOD = {"event_id": "a" * 64, "source_type": "news", "source_name": "gdelt", "event_time": "2024-01-01T00:00:00Z", "collected_at": "2024-01-01T01:00:00+09:00", "language": "en", "title": None, "text": "hello", "url": None, "community": None, "engagement": 3, "schema_version": 1, "metadata": {"a": "b"}}


def errors(spark, texts, strict=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [r.contract_errors for r in add_contract(read_raw(df, "v"), strict).orderBy("i").select("contract_errors").collect()]


def test_each_code(spark):
    one = lambda **k: json.dumps(GOOD | k)
    cases = {
        one(): [],
        one(extra=1): ["UNEXPECTED_FIELDS"],
        one(event_id="A" * 64): ["INVALID_EVENT_ID"],
        one(event_id="a" * 64 + "\n"): ["INVALID_EVENT_ID"],
        one(source_type="blog"): ["INVALID_SOURCE_TYPE"],
        one(source_name=None): ["INVALID_SOURCE_NAME"],
        one(event_time="yesterday"): ["INVALID_EVENT_TIME"],
        one(collected_at=None): ["INVALID_COLLECTED_AT"],
        one(language="  "): ["MISSING_LANGUAGE"],
        one(text=""): ["MISSING_TEXT"],
        one(text="\t\n"): [],
        one(schema_version=2): ["UNSUPPORTED_SCHEMA_VERSION"],
        one(metadata=None): ["MISSING_METADATA"],
        one(engagement="x"): ["MALFORMED_JSON"],
        one(event_time="2024-01-01"): [],
    }
    assert errors(spark, cases) == list(cases.values())


def test_broken_json_order_and_nulls(spark):
    got = errors(spark, ["not json", "[1]", None, "", "{}"])
    assert got[0][0] == got[1][0] == "MALFORMED_JSON"
    assert "MALFORMED_JSON" not in got[2] + got[3] + got[4] and "MISSING_FIELDS" in got[2]
    for e in got:
        assert e == [c for c in rules() if c in e]


def test_strict_wants_zones_and_real_text(spark):
    one = lambda **k: json.dumps(GOOD | k)
    assert errors(spark, [one(), one(event_time="2024-01-01T00:00:00"), one(text="\t　\n"), one(collected_at="2024-01-01")], strict=True) == [[], ["INVALID_EVENT_TIME"], ["MISSING_TEXT"], ["INVALID_COLLECTED_AT"]]


def test_require_valid_fails(spark):
    df = read_raw(spark.createDataFrame([(json.dumps(GOOD),), ("no",)], "v string"), "v")
    with pytest.raises(Exception, match="contract: MALFORMED_JSON"):
        require_valid(add_contract(df)).count()


def plain(text):
    """The policy written out for one text."""
    control = lambda c: unicodedata.category(c) == "Cc" and c not in "\t\n\r"
    clean = unicodedata.normalize("NFC", "".join(c for c in text if not control(c) and c not in quality.ZERO_WIDTH)).strip()
    run = best = 0
    for c in clean:
        run = run + 1 if unicodedata.combining(c) else 0
        best = max(best, run)
    compact = "".join(clean.split())
    ratio = 0.0
    if len(compact) >= 100:
        data = compact.encode()
        ratio = max(max(map(compact.count, set(compact))) / len(compact), 1 - len(zlib.compress(data)) / len(data), 0)
    return clean, sum(map(control, text)), sum(c in quality.ZERO_WIDTH for c in text), best, ratio


def test_quality_against_plain_python(spark):
    rng = random.Random(8)
    bits = ["a", "b ", "é", "é", "́" * 9, "\x07", "​", "﻿", "\xa0", "\n", "　", "😀", "word " * 30, "x" * 120, "\x85", "\x1c"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(200)]
    df = quality.add_quality(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")).orderBy("i").collect()
    for r, t in zip(df, texts):
        clean, controls, zeros, run, ratio = plain(t)
        assert (r.text_clean, r.control_character_count, r.zero_width_count, r.max_combining_mark_run) == (clean, controls, zeros, run), repr(t)
        assert r.repetition_ratio == pytest.approx(ratio, abs=1e-4) and r.was_normalized == (clean != t)


@pytest.mark.parametrize(
    "text, status, flags, reason",
    [
        ("A normal headline.", "accept", [], None),
        (" [Removed] ", "reject", ["SOURCE_TOMBSTONE"], "SOURCE_TOMBSTONE"),
        ("​ \t", "reject", ["EMPTY_AFTER_NORMALIZATION", "ZERO_WIDTH_CHARACTERS"], "EMPTY_AFTER_NORMALIZATION"),
        ("ab " * 1667, "flag", ["EXCESSIVE_LENGTH", "HIGH_REPETITION"], None),
        ("mail a.b@example.com now", "quarantine", ["POSSIBLE_PII"], "POSSIBLE_PII"),
        ("call +82 10-1234-5678 now", "quarantine", ["POSSIBLE_PII"], "POSSIBLE_PII"),
        ("id 12345678", "accept", [], None),
        ("https://a.example/x https://b.example/y", "flag", ["URL_HEAVY"], None),
        ("see www.example.com", "accept", [], None),
        ("x" * 150, "flag", ["HIGH_REPETITION"], None),
        ("q" + "̖" * 9, "quarantine", ["EXCESSIVE_COMBINING_MARKS"], "EXCESSIVE_COMBINING_MARKS"),
        ("a\x00b", "flag", ["CONTROL_CHARACTERS"], None),
    ],
)
def test_policy_cases(spark, text, status, flags, reason):
    r = quality.add_quality(spark.createDataFrame([(text,)], "text string")).first()
    assert (r.quality_status, r.quality_flags, r.exclusion_reason) == (status, flags, reason)


def test_filters_on_flags_stay_above_what_leads_to_them(spark, sf):
    df = registry.QUERIES["q_repetition_zlib"](spark, sf)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 200_000 and plan.count("ArrowEvalPython") == 2  # NFC and the repetition figures once each
    ratios = {r.doc_id: round(plain(r.text)[-1], 4) for r in views.events(spark, sf).select("doc_id", "text").collect()}
    assert {r.doc_id: r.repetition_ratio for r in df.collect()} == {i: x for i, x in ratios.items() if x >= quality.REPETITION_RATIO}


def test_runs_of_marks_are_those_of_the_unicode_data(spark):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    parts = ["a" + "a".join(points[i : i + 10_000]) for i in range(0, len(points), 10_000)]
    got = spark.createDataFrame([(t,) for t in parts], "t string").select(F.explode(quality.marks_in(F.col("t"))).alias("m")).collect()
    assert sorted(r.m for r in got) == sorted(c for c in points if unicodedata.combining(c))
    text = spark.createDataFrame([("한국어 텍스트 そして 漢字 ру é 😀",), ("e\u0301\u0316 x\u0327",)], "t string")
    assert [r.m for r in text.select(quality.marks_in(F.col("t")).alias("m")).collect()] == [None, ["\u0301\u0316", "\u0327"]]


def test_limits_are_exact(spark):
    texts = ["".join(chr(97 + i * 7 % 26) + str(i) for i in range(3000))[:n] for n in (5000, 5001)] + ["ab" * 10000, "ab" * 10000 + "c"]
    got = quality.add_quality(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")).orderBy("i").collect()
    assert [("EXCESSIVE_LENGTH" in r.quality_flags, r.exclusion_reason) for r in got] == [(False, None), (True, None), (True, None), (True, "EXCESSIVE_LENGTH")]


def test_generator_facts_and_accounting(spark, tmp_path):
    assert S.generate(spark, 101).select("event_id").distinct().count() == 99
    df = S.generate(spark, 1000, 7).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("v"))
    routed = routing.add_route(routing.transform(read_raw(df, "v"))).persist()
    a = accounting.checked(accounting.account(routed), 1000).first()
    assert (a.unique_rows, a.duplicate_rows, a.rejected_rows) == (981, 19, 0)
    first = dedup.first_wins(routed.where("contract_valid"), ["event_id"], [F.col("collected_at")])
    assert {r.quality_status: r["count"] for r in first.groupBy("quality_status").count().collect()} == {"accept": 891, "flag": 50, "quarantine": 30, "reject": 10}
    with pytest.raises(Exception, match="accounting"):
        accounting.checked(accounting.account(routed), 999).collect()
    routed.unpersist()


def test_batch_of_104(spark, tmp_path):
    S.generate(spark, 101, 1).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.text(str(tmp_path / "in"))
    extra = spark.createDataFrame([('{"event_id":"missing-fields"}',), (json.dumps(GOOD | {"x": 1}),), ("not-json",), (" ",)], "value string")
    extra.coalesce(1).write.mode("append").text(str(tmp_path / "in"))
    a = accounting.account(add_contract(S.read_jsonl(spark, str(tmp_path / "in")))).first()
    assert (a.input_rows, a.rejected_rows, a.duplicate_rows, a.unique_rows) == (104, 3, 2, 99)


def test_merge_keeps_nulls_of_the_deciding_row(spark):
    df = spark.createDataFrame([(1, 1, "a", 5), (1, 2, "b", None), (2, 1, None, 1)], "k int, o int, t string, e int")
    got = {r.k: (r.t, r.e) for r in dedup.merge(df, ["k"], [F.col("o")], ["t"], ["e"]).collect()}
    assert got == {1: ("a", None), 2: (None, 1)}
    again = dedup.upsert(df.where("o = 1"), df.where("o = 2"), ["k"], [F.col("o")], ["t"], ["e"])
    assert {r.k: (r.t, r.e) for r in again.collect()} == got


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "v string")
    routed = routing.add_route(routing.transform(read_raw(none, "v")))
    assert routed.count() == 0
    assert accounting.account(routed).first().input_rows == 0
    assert accounting.length_summary(routed).first().avg_chars is None
