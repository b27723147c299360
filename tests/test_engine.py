import importlib
import json
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from textlake.functions import analysis as A
from textlake.functions import cost, labels, text as X
from textlake.operators import groups as G
from textlake.operators import intervals, sampling, serving
from textlake.sources import events as S
from textlake.sources import sinks
from textlake.streaming import consumer
from textlake.plans import registry, views


def tables(sf):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


SLOW = ("q_stream_routes",)


@pytest.mark.parametrize("name", [n for n in registry.SQL if n not in SLOW])
def test_query_equals_sql(spark, sf, name):
    a, b = registry.QUERIES[name](spark, sf).toPandas(), tables(sf).sql(registry.SQL[name]).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    key = lambda d: sorted(repr([None if x is None or x != x else round(float(x), 9) if isinstance(x, float) else x.item() if hasattr(x, "item") else x for x in r]) for r in d[cols].astype(object).itertuples(index=False))
    assert key(a) == key(b)


def test_titles_cut_within_a_reference_equal_sql(spark, tmp_path):
    titles = ["a&amp;&amp", "a &lt;b&gt &quot;c&quo", "x &amp;lt; &amp;amp; &copy; &#39;y&#39;", "no title", ""]
    rows = [(i, f"<html><title>{t}</title></html>" if t != "no title" else "<html></html>") for i, t in enumerate(titles)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"file://{tmp_path}/pages.parquet")
    got = {r.page_id: r.title for r in registry.QUERIES["q_title_normalize"](spark, f"file://{tmp_path}").collect()}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == dict(c.sql(registry.SQL["q_title_normalize"]).fetchall()) and got[0] == "a&&amp"


def test_stream_restart_and_ledger(spark, sf, tmp_path):
    msgs = views.messages(spark, sf)
    c = consumer.ConsumerConfig("t", "dead", f"file://{tmp_path}/out", f"file://{tmp_path}/check", watermark="3650 days")
    read = lambda: consumer.file_messages(spark, f"file://{tmp_path}/topic")
    count = lambda: consumer.read_ledger(spark, f"{tmp_path}/out").agg(F.sum("row_count")).first()[0]
    msgs.where("offset < 30").write.parquet(f"file://{tmp_path}/topic")
    consumer.start(read(), c).awaitTermination()
    first = count()
    consumer.start(read(), c).awaitTermination()
    assert count() == first  # nothing new, no batch
    msgs.where("offset >= 20").write.mode("append").parquet(f"file://{tmp_path}/topic")
    consumer.start(read(), c).awaitTermination()
    routed = consumer.routing.add_route(consumer.routing.transform(consumer.routing.parse_messages(msgs)))
    keys = routed.select(F.when(F.col("contract_valid"), F.col("event_id")).otherwise(consumer.routing.message_key())).distinct().count()
    assert count() == keys  # overlapping offsets were taken once
    assert spark.read.json(f"{tmp_path}/out/dead_letters").where("value LIKE '%CONTRACT_REJECTED%'").count() == routed.where("NOT contract_valid").count()


def test_stream_plan_and_batch_is_repeatable(spark, sf, tmp_path):
    views.messages(spark, sf).write.parquet(f"file://{tmp_path}/topic")
    df = consumer.prepared(consumer.file_messages(spark, f"file://{tmp_path}/topic"), "10 minutes")
    assert "DeduplicateWithinWatermark" in df._jdf.queryExecution().analyzed().toString()
    batch = consumer.routing.add_route(consumer.routing.transform(consumer.routing.parse_messages(views.messages(spark, sf))))
    for _ in range(2):
        consumer.write_batch(batch, 7, f"file://{tmp_path}/out", "c", "s")
    entry = consumer.read_ledger(spark, f"file://{tmp_path}/out").collect()
    assert [(r.consumer_name, r.stream, r.batch_id, r.row_count) for r in entry] == [("c", "s", 7, batch.count())]
    counts = {r.output_route: r["count"] for r in batch.groupBy("output_route").count().collect()}
    assert json.loads(entry[0].route_counts) == counts
    for route, n in counts.items():
        assert consumer.read_written(spark, f"file://{tmp_path}/out", route, "event_id string").count() == n
    stored = spark.read.parquet(f"{tmp_path}/out/events")
    assert not set(sinks.INTERNAL) & set(stored.columns) and stored.where("letter IS NOT NULL").count() == counts["contract_rejected"]


def test_consumers_and_checkpoints_lose_nothing(spark, sf, tmp_path):
    """A second consumer on one root, and a new checkpoint in the place of a lost one, write their batches too."""
    import shutil

    root, msgs = f"file://{tmp_path}", views.messages(spark, sf)
    msgs.where("offset < 20").write.parquet(f"{root}/a")
    msgs.where("offset >= 20").write.parquet(f"{root}/b")
    ids = lambda df: df.groupBy("consumer_name").agg(F.sum("row_count").alias("n"))

    def consume(topic, name):
        c = consumer.ConsumerConfig("t", "dead", f"{root}/out", f"{root}/check-{name}", watermark="3650 days", name=name)
        consumer.start(consumer.file_messages(spark, f"{root}/{topic}"), c).awaitTermination()

    consume("a", "one")
    consume("b", "two")
    got = {r.consumer_name: r.n for r in ids(consumer.read_ledger(spark, f"{root}/out")).collect()}
    assert set(got) == {"one", "two"} and min(got.values()) > 20
    shutil.rmtree(tmp_path / "check-one")
    consume("b", "one")
    again = {r.consumer_name: r.n for r in ids(consumer.read_ledger(spark, f"{root}/out")).collect()}
    assert again == {"one": got["one"] + got["two"], "two": got["two"]}
    assert consumer.read_ledger(spark, f"{root}/out").where("consumer_name = 'one'").select("stream").distinct().count() == 2
    with pytest.raises(ValueError, match="name"):
        consumer.ConsumerConfig("t", "d", "o", "c", name="a/b")


@pytest.mark.parametrize("bad", [dict(dead_letter_topic="t"), dict(max_offsets_per_trigger=0), dict(starting_offsets="soon"), dict(starting_offsets="[1]")])
def test_consumer_config(bad):
    good = dict(input_topic="t", dead_letter_topic="d", output_root="o", checkpoint="c")
    consumer.ConsumerConfig(**good)
    with pytest.raises(ValueError):
        consumer.ConsumerConfig(**good | bad)


def test_archive_day_border_and_case(spark):
    rows = [("a", "x", 1451606399, "News", 1, "l", 0), ("b", "y", 1451606400, "nEWS", 1, "l", 0), ("c", "z", 1451606400, "other", 1, "l", 0), ("d", "z", None, "news", 1, "l", 0)]
    df = spark.createDataFrame(rows, "id string, body string, created_utc long, subreddit string, score long, link_id string, controversiality long")
    got = {r.id: (r.year, r.month, r.day) for r in S.archive_days(S.require_columns(df), ["NEWS"]).collect()}
    assert got == {"a": ("2015", "12", "31"), "b": ("2016", "01", "01")}
    with pytest.raises(ValueError, match="score"):
        S.require_columns(df.drop("score"))


def test_pushdown_and_pruning(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS created_utc", "'n' AS subreddit", "'t' AS text", "2024 AS year", "CAST(id % 3 + 1 AS INT) AS month", "concat('s', id) AS event_id", "'reddit' AS source_name")
    sinks.write_partitioned(df, f"{tmp_path}/p", ["year", "month"])
    plan = S.read_period(spark, f"{tmp_path}/p", 2024, 2, ["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters")[1].split("]")[0] and "ReadSchema: struct<event_id:string>" in plan
    plan = S.archive_rows(spark.read.parquet(f"{tmp_path}/p"), ["n"], 5, 9)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_utc,5)" in plan and "LessThan(created_utc,9)" in plan
    sinks.write_days(df.where("month = 1").limit(1), f"{tmp_path}/p", ("year", "month"))
    assert spark.read.parquet(f"{tmp_path}/p").count() == 1 + df.where("month <> 1").count()


def test_sources(spark, tmp_path):
    (tmp_path / "allow.txt").write_text("# names\nNews\n\nscience # good\n")
    assert sorted(r.name for r in S.allowlist(spark, str(tmp_path / "allow.txt")).collect()) == ["News", "science"]
    (tmp_path / "twice.txt").write_text("News\nnews\n")
    with pytest.raises(Exception, match="repeated name"):
        S.allowlist(spark, str(tmp_path / "twice.txt")).collect()
    (tmp_path / "c.csv").write_text("month,filename,bytes\n2012-01,a,5\n2012-02,b,6\n2012-03,c,7\n")
    assert [r.bytes for r in S.read_catalog(spark, str(tmp_path / "c.csv"), "2012-02", "2012-03").collect()] == [6, 7]
    assert S.read_route(spark, str(tmp_path / "nothing"), "a int").count() == 0
    assert S.list_files(spark, str(tmp_path)).first().files == 3
    sizes = S.month_sizes(spark.createDataFrame([("RC_2012-02.parquet", 2**30), ("x.txt", 1)], "name string, bytes long")).collect()
    assert [(r.month, r.gib, r.average_daily_mib) for r in sizes] == [("2012-02", 1.0, round(1024 / 29, 4))]
    xml = "<rss><channel><item><title>Rates up - The Paper</title><link>http://a/1</link><pubDate>Tue, 02 Jan 2024 09:00:00 GMT</pubDate><source>The Paper</source></item><item><title>No link</title><pubDate>x</pubDate></item></channel></rss>"
    got = S.rss_items(spark.createDataFrame([("g1", xml)], "topic string, xml string")).collect()
    assert [(r.topic, r.title, r.publisher, r.published.isoformat()) for r in got] == [("g1", "Rates up", "The Paper", "2024-01-02T09:00:00")]
    html = '<div class="card"><a href="/x">A &amp; B</a><b>2024</b></div><div class="card"><a href="/y">C</a></div>'
    cards = S.html_cards(spark.createDataFrame([(1, html)], "p int, html string"), "html", '<div class="card">.*?</div>', href='href="([^"]*)"', title="<a[^>]*>([^<]*)<", date="<b>([^<]*)<")
    assert [(r.href, r.title, r.date) for r in cards.collect()] == [("/x", "A & B", "2024"), ("/y", "C", "")]
    good = {"event_id": "a" * 64, "source_type": "news", "source_name": "gdelt", "event_time": "2024-01-01T00:00:00Z", "collected_at": "2024-01-01T00:00:00Z", "language": "en", "title": None, "text": "t", "url": None, "community": None, "engagement": None, "schema_version": 1, "metadata": {}}
    (tmp_path / "e.jsonl").write_text(json.dumps(good) + "\n\n")
    assert S.read_jsonl_strict(spark, str(tmp_path / "e.jsonl")).count() == 1
    (tmp_path / "f.jsonl").write_text(json.dumps(good | {"event_time": "2024-01-01"}) + "\n")
    with pytest.raises(Exception, match="INVALID_EVENT_TIME"):
        S.read_jsonl_strict(spark, str(tmp_path / "f.jsonl")).collect()


def test_semantics(spark):
    tone = [{"tone": "hope", "share": 0.5, "drivers": ["x"]}, {"tone": "trust", "share": 0.7, "drivers": ["y"]}]
    rows = [("a", (0.4, 0.2, 0.4), tone, []), ("b", (0.6, 0.4, 0.0), tone, []), ("c", (0.2, 0.3, 0.5), [], None)]
    df = spark.createDataFrame(rows, "k string, d struct<positive:double,neutral:double,negative:double>, positive_tones array<struct<tone:string,share:double,drivers:array<string>>>, negative_tones array<struct<tone:string,share:double,drivers:array<string>>>")
    out = {r.k: r for r in A.derive_sentiment(df, "d").withColumn("n", A.normalize_tones(F.col("positive_tones"))).withColumn("e", A.semantics_errors(A.derive_sentiment(df, "d"), "d")).collect()}
    assert [(out[k].dominant_sentiment, out[k].sentiment_score) for k in "abc"] == [("neutral", 0.0), ("positive", 0.6), ("negative", -0.3)]
    assert [t.share for t in out["a"].n] == [0.416667, 0.583333]
    assert out["a"].e == ["positive_tones_sum", "negative_tones_missing"] and out["c"].e == ["positive_tones_missing"]


def test_label_gate(spark):
    df = spark.createDataFrame([(["Economy", "economy", "café", None], ["ＡＩ policy", "x" * 24, "a\tb"]), (None, [])], "topics array<string>, keywords array<string>")
    a, b = labels.gate(df).collect()
    assert a.topics == ["Economy"] and a.keywords == ["AI policy", "ab"] and a.removed_labels == 4 and a.gate_status == "modified"
    assert b.topics == [] and b.removed_labels == 0


def test_small_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    lit = F.lit
    assert one(X.canonical_url(lit(" HTTPS://user@Example.COM:443?b=2&utm_x=1&a=1&fbclid=3#f"))) == "https://example.com/?a=1&b=2"
    assert one(X.canonical_url(lit("no url"))) is None
    assert one(X.normalize_title(lit(" A &amp; B\n\xa0C "))) == "A & B C"
    assert one(X.duration(lit(3661))) == "1h 01m 01s"
    assert one(X.redact(lit("see https://hooks.slack.com/services/T/B api_key=abc, sk-12345678x"))) == "see [REDACTED_SLACK_WEBHOOK] api_key=[REDACTED], [REDACTED_OPENAI_KEY]"
    assert one(cost.tokens(lit(""))) == 1 and one(cost.tokens(lit("é" * 4))) == 2
    assert str(one(cost.cost(lit(300_000), lit(1000), "0.10", "0.60", True))) == "0.06090000"
    assert one(cost.budget_status(lit(9), lit(None).cast("int"))) == "not_configured"
    with pytest.raises(ValueError):
        cost.budget_status(lit(1), lit(2), "other")
    with pytest.raises(ValueError):
        serving.of_version("v9")
    with pytest.raises(ValueError):
        serving.positive(0)


def test_sample_is_the_same_in_any_partitioning(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 40) END AS k")
    a = {tuple(r) for r in sampling.per_group(df.repartition(3), ["k"], "id", 20).select("k", "id").collect()}
    b = {tuple(r) for r in sampling.per_group(df.repartition(11), ["k"], "id", 20).select("k", "id").collect()}
    assert a == b and sum(k == "hot" for k, _ in a) == 20


def test_comparison_balance(spark):
    daily = spark.createDataFrame([("d", "a", 3, 30), ("d", "b", 4, 40), ("d", "cmp", 10, 101), ("e", "cmp", 5, 5)], "day string, group_name string, row_count long, tokens long")
    got = {r.day: (r.target_rows, r.target_tokens) for r in G.comparison_target(daily, "cmp").collect()}
    assert got == {"d": (4, 41), "e": (0, 0)}


def test_day_coverage_reasons(spark):
    w = spark.createDataFrame([("a", "2024-01-01 00:00:00", "2024-01-02 00:00:00"), ("b", "2024-01-01 00:00:00", "2024-01-01 10:00:00"), ("b", "2024-01-01 09:00:00", "2024-01-01 20:00:00"), ("c", "2024-01-01 00:00:00", "2024-01-01 10:00:00"), ("c", "2024-01-01 11:00:00", "2024-01-02 03:00:00"), ("d", "2024-01-03 00:00:00", "2024-01-04 00:00:00")], "source string, a string, z string")
    w = w.select("source", F.to_timestamp("a").alias("window_start"), F.to_timestamp("z").alias("window_end"))
    days = spark.sql("SELECT DATE'2024-01-01' AS day, TIMESTAMP'2024-01-01' AS day_start, TIMESTAMP'2024-01-02' AS day_end")
    got = {r.source: r.reason for r in intervals.uncovered_days(w, days, ["source"]).collect()}
    assert got == {"b": "early end", "c": "gap", "d": "no window"}


def test_entry_works_without_the_optional_subpackage(spark, monkeypatch):
    for name in [m for m in sys.modules if m.startswith(("textlake.llm", "corpus_pipeline", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, name)
    real = importlib.import_module

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name in ("textlake.llm", "corpus_pipeline"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    entry = real("__spark_entry__")
    assert not any(n.startswith("op") or n == "pipeline" for n in entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries()) and entry.entry(spark).columns
    monkeypatch.undo()
    sys.modules.pop("__spark_entry__", None)


def test_command_line(spark, sf, tmp_path, capsys):
    from textlake.__main__ import main

    (tmp_path / "in.jsonl").write_text("\n".join(r.v for r in S.generate(spark, 60).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("v")).collect()) + "\nno\n")
    main(["batch", "--input", f"{tmp_path}/in.jsonl", "--output", f"{tmp_path}/batch", "--expected-rows", "61"])
    assert json.loads(capsys.readouterr().out)["unique_rows"] == 59 == spark.read.parquet(f"{tmp_path}/batch/valid").count()
    views.messages(spark, sf).write.parquet(f"file://{tmp_path}/topic")
    main(["stream", "--input", f"file://{tmp_path}/topic", "--output", f"file://{tmp_path}/out", "--checkpoint", f"file://{tmp_path}/check", "--watermark", "3650 days"])
    main(["verify", "--output", f"file://{tmp_path}/out"])
    main(["bounded", "--input", f"file://{tmp_path}/topic", "--output", f"file://{tmp_path}/run", "--ranges", '[["events", 0, 0, 40]]', "--run-id", "run-0", "--analysis-date", "2024-01-01"])
    last = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert last["read_rows"] == 40 and last["run_rows"] + last["foreign_rows"] == 40
    for _ in range(2):
        main(["publish", "--input", f"{tmp_path}/in.jsonl", "--log", f"file://{tmp_path}/log", "--partitions", "2", "--writer", "once"])
    main(["stream", "--log", f"file://{tmp_path}/log", "--account-all", "--output", f"file://{tmp_path}/all", "--checkpoint", f"file://{tmp_path}/check2"])
    counts = {}
    for r in consumer.read_ledger(spark, f"file://{tmp_path}/all").collect():
        for k, n in json.loads(r.route_counts).items():
            counts[k] = counts.get(k, 0) + n
    assert sum(counts.values()) == 61 and counts["duplicate"] == 1 and counts["contract_rejected"] == 1
    main(["copy", "--input", f"file://{tmp_path}/batch", "--output", f"file://{tmp_path}/copied"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1]).keys() == {"copied"}


def test_dates(spark):
    from textlake.functions import dates

    days = lambda *a, **k: [str(r.day) for r in dates.analysis_days(spark, *a, **k).collect()]
    assert days("2024-03-01T14:59:00Z") == ["2024-02-29"] and days("2024-03-01T15:00:00+00:00", "2024-01-01", "2024-01-02", scheduled=True) == ["2024-03-01"]
    assert days("2024-03-01T00:00:00Z", "2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    for bad in (("2024-03-01T00:00:00",), ("2024-03-01T00:00:00Z", "2024-01-01"), ("2024-03-01T00:00:00Z", "2024-01-02", "2024-01-01")):
        with pytest.raises(ValueError):
            days(*bad)
    a, z = dates.day_bounds(F.lit("2024-01-02").cast("date"))
    r = spark.range(1).select(a.alias("a"), z.alias("z"), *[c.alias(f"e{i}") for i, c in enumerate(dates.epoch_bounds(F.to_date(F.lit("1970-01-02")), F.to_date(F.lit("1970-01-03"))))]).first()
    assert (str(r.a), str(r.z), r.e0, r.e1) == ("2024-01-01 15:00:00", "2024-01-02 15:00:00", 86400, 259200)
