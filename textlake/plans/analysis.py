"""Queries of analyses: serving, reconciliation, semantics, labels, costs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import analysis as A
from ..functions import contract, cost, labels
from ..operators import reconcile, serving
from . import views

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


AN, RES, JOB = "WITH " + views.ANALYSES_SQL, "WITH " + views.RESULTS_SQL, "WITH " + views.JOBS_SQL
V3 = "regexp_matches(prompt_version, '(^|-)v3($|-)')"


@query(f"{AN} SELECT count(*) AS analysis_rows, count(*) FILTER (sentiment = 'positive') AS positive_rows, count(*) FILTER (sentiment = 'neutral') AS neutral_rows, count(*) FILTER (sentiment = 'negative') AS negative_rows, count(*) FILTER (sentiment = 'mixed') AS mixed_rows, round(coalesce(avg(sentiment_score), 0), 9) AS average_sentiment_score, round(coalesce(avg(polarization_score), 0), 9) AS average_polarization_score FROM an")
def q_serving_summary(spark, d):
    return serving.summary(views.analyses(spark, d), "all").withColumns({c: F.round(c, 9) for c in ("average_sentiment_score", "average_polarization_score")})


@query(f"{AN} SELECT sentiment, count(*) AS row_count FROM an WHERE {V3} GROUP BY sentiment")
def q_serving_sentiment(spark, d):
    return serving.by_label(views.analyses(spark, d), "sentiment", keep_null=True)


@query(f"{AN} SELECT polarization, count(*) AS row_count FROM an WHERE polarization IS NOT NULL GROUP BY polarization")
def q_serving_polarization(spark, d):
    return serving.by_label(views.analyses(spark, d), "polarization", "all")


@query(f"{AN} SELECT topic, count(*) AS row_count FROM (SELECT unnest(topics) AS topic FROM an WHERE {V3}) WHERE trim(topic) <> '' GROUP BY topic ORDER BY row_count DESC, topic LIMIT 15")
def q_serving_topics(spark, d):
    return serving.topics(views.analyses(spark, d))


@query(f"{AN} SELECT lower(trim(topic)) AS topic, count(*) AS row_count FROM (SELECT unnest(topics) AS topic FROM an) WHERE trim(topic) <> '' GROUP BY ALL ORDER BY row_count DESC, topic LIMIT 10")
def q_topic_topk_folded(spark, d):
    return serving.topics(views.analyses(spark, d), "all", 10, fold=True)


@query(f"{JOB} SELECT llm_batch_id, status, model, requested_count, completed_count, failed_count, input_tokens, output_tokens, CAST(total_cost_usd AS VARCHAR) AS total_cost_usd, submitted_at, completed_at FROM job ORDER BY coalesce(completed_at, submitted_at, created_at) DESC, llm_batch_id LIMIT 12")
def q_serving_batches(spark, d):
    return serving.batches(views.jobs(spark, d), "all", 12).withColumn("total_cost_usd", F.col("total_cost_usd").cast("string"))


@query(f"{AN}, {views.RESULTS_SQL} SELECT event_id, sentiment, sentiment_score, p || '/' || u || '/' || n AS sentiment_distribution, polarization, polarization_score, array_to_string(list_transform(positive_tones, lambda x: x.tone), ',') AS positive_tones, array_to_string(list_transform(negative_tones, lambda x: x.tone), ',') AS negative_tones, array_to_string(topics, ',') AS topics, array_to_string(keywords, ',') AS keywords, 'Summary ' || an.doc_id AS summary, 'model-' || (an.doc_id % 3) AS model, analyzed_at, llm_batch_id FROM an JOIN man USING (custom_id) WHERE {V3} ORDER BY analyzed_at DESC, event_id LIMIT 50")
def q_serving_analyses(spark, d):
    an = views.analyses(spark, d).withColumnRenamed("dist", "sentiment_distribution").withColumns({"summary": F.concat(F.lit("Summary "), F.col("doc_id")), "model": F.concat(F.lit("model-"), F.col("doc_id") % 3)})
    shares = F.concat_ws("/", *[F.col(f"sentiment_distribution.{k}").cast("string") for k in A.SENTIMENTS])
    tones = {c: F.array_join(F.transform(c, lambda t: t["tone"]), ",") for c in ("positive_tones", "negative_tones")}
    return serving.analyses(an, views.requests(spark, d)).withColumns({"sentiment_distribution": shares, "topics": F.array_join("topics", ","), "keywords": F.array_join("keywords", ","), **tones})


@query(f"{RES} SELECT custom_id, llm_batch_id, CASE WHEN r.c IS NULL THEN 'failed' ELSE 'completed' END AS status, CASE WHEN r.c IS NULL THEN 'missing_result' ELSE 'validated' END AS validation_result, CASE WHEN r.c IS NULL THEN 'MISSING_RESULT' END AS error_code FROM man LEFT JOIN (SELECT DISTINCT custom_id AS c FROM res) AS r ON r.c = custom_id")
def q_manifest_left_join(spark, d):
    one = views.results(spark, d).where("turn = 0")
    return reconcile.request_states(views.requests(spark, d), one, "completed").drop("doc_id")


@query(f"{RES} SELECT custom_id FROM man WHERE custom_id NOT IN (SELECT custom_id FROM res)")
def q_missing_results(spark, d):
    return reconcile.missing_results(views.requests(spark, d), views.results(spark, d)).select("custom_id")


@query(f"{RES} SELECT custom_id, turn FROM res WHERE custom_id NOT IN (SELECT custom_id FROM man)")
def q_unknown_results(spark, d):
    return reconcile.unknown_results(views.requests(spark, d), views.results(spark, d)).select("custom_id", F.col("turn").cast("long").alias("turn"))


@query(f"{RES}, k AS (SELECT custom_id, count(*) AS n FROM res GROUP BY ALL), j AS (SELECT k.n, man.custom_id AS m FROM k FULL JOIN man ON man.custom_id = k.custom_id) SELECT count(*) FILTER (n IS NOT NULL AND m IS NOT NULL) AS accepted, CAST(coalesce(sum(n - 1) FILTER (m IS NOT NULL), 0) AS BIGINT) AS repeated, CAST(coalesce(sum(n) FILTER (m IS NULL), 0) AS BIGINT) AS unknown, count(*) FILTER (n IS NULL) AS missing FROM j")
def q_result_first_wins(spark, d):
    return reconcile.accepted_results(views.requests(spark, d), views.results(spark, d), [F.col("turn")])[1]


@query(f"{RES}, g AS (SELECT batch_id, count(*) AS generation_count, count(input_tokens) AS available, CAST(sum(input_tokens) AS BIGINT) AS si, CAST(sum(output_tokens) AS BIGINT) AS so FROM res GROUP BY batch_id), b AS (SELECT batch_id, CASE WHEN generation_count % 3 = 0 THEN NULL ELSE si + generation_count % 2 END AS input_tokens, so AS output_tokens, available AS expected FROM g) SELECT batch_id, generation_count, si AS sum_input, CASE WHEN b.input_tokens IS NULL OR available = 0 THEN 'not_available' WHEN si = b.input_tokens AND so = b.output_tokens THEN 'matched' ELSE 'mismatched' END AS reconciliation FROM g JOIN b USING (batch_id)")
def q_usage_reconcile(spark, d):
    res = views.results(spark, d)
    reported = res.groupBy("batch_id").agg(
        F.when(F.count("*") % 3 != 0, F.sum("input_tokens") + F.count("*") % 2).alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.count("input_tokens").alias("expected_count")
    )
    return reconcile.reconcile_usage(res, reported).select("batch_id", "generation_count", "sum_input", "reconciliation")


@query(f"{JOB}, c AS (SELECT *, input_tokens > 272000 AS l FROM job) SELECT llm_batch_id, CAST(CAST((input_tokens * (CASE WHEN l THEN 0.20 ELSE 0.10 END) + output_tokens * (CASE WHEN l THEN 0.90 ELSE 0.60 END)) / 1000000 AS DECIMAL(18,8)) AS DOUBLE) AS cost_usd FROM c")
def q_token_cost(spark, d):
    c = cost.cost(F.col("input_tokens"), F.col("output_tokens"), "0.10", "0.60", long_context=True)
    return views.jobs(spark, d).select("llm_batch_id", c.cast("double").alias("cost_usd"))


@query(f"{JOB} SELECT round(CAST(sum((input_tokens * 0.10 + output_tokens * 0.60) / 1000000) AS DOUBLE), 8) AS total_cost_usd FROM job")
def q_total_cost(spark, d):
    c = cost.cost(F.col("input_tokens"), F.col("output_tokens"), "0.10", "0.60")
    return views.jobs(spark, d).agg(F.round(F.sum(c).cast("double"), 8).alias("total_cost_usd"))


@query("WITH o AS (SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(18,2)) AS s, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(150000 AS DECIMAL(18,2)) END AS b FROM orders) SELECT id, CASE WHEN b IS NULL THEN 'not_configured' WHEN s >= b THEN 'blocked' WHEN s >= 0.9 * b THEN 'critical' WHEN s >= 0.7 * b THEN 'warning' ELSE 'ok' END AS ratio_status, CASE WHEN b IS NULL THEN 'not_configured' WHEN s > b THEN 'blocked' ELSE 'ok' END AS limit_status, CASE WHEN s > b THEN 'blocked' ELSE 'ok' END AS open_status FROM o")
def q_budget(spark, d):
    """What orders cost against a budget that some of them have."""
    df = views.load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(18,2)").alias("spent"))
    spent, budget = F.col("spent"), F.when(F.col("id") % 6 != 0, F.lit("150000").cast("decimal(18,2)"))
    return df.select("id", cost.budget_status(spent, budget).alias("ratio_status"), cost.budget_status(spent, budget, "limit").alias("limit_status"), cost.budget_status(spent, budget, "open").alias("open_status"))


@query("SELECT doc_id, 'req-' || left(sha256('docs:' || source || ':' || doc_id), 24) AS request_id, greatest(1, (strlen(text) + 3) // 4) AS tokens FROM documents")
def q_request_keys(spark, d):
    docs = views.load(spark, d, "documents")
    return docs.select("doc_id", cost.request_id("req", F.lit("docs"), F.col("source"), F.col("doc_id").cast("string")).alias("request_id"), cost.tokens(F.col("text")).alias("tokens"))


@query(f"{AN} SELECT doc_id, CASE WHEN p = n THEN 'neutral' WHEN p >= u AND p >= n THEN 'positive' WHEN u >= n THEN 'neutral' ELSE 'negative' END AS dominant_sentiment, round(p - n, 6) AS sentiment_score FROM an")
def q_sentiment_derive(spark, d):
    return A.derive_sentiment(views.analyses(spark, d), "dist").select("doc_id", "dominant_sentiment", "sentiment_score")


@query(f"{AN} SELECT doc_id, CASE WHEN p >= u AND p >= n THEN 'positive' WHEN u >= n THEN 'neutral' ELSE 'negative' END AS dominant_sentiment FROM an")
def q_sentiment_correct_v2(spark, d):
    return A.correct_dominant(views.analyses(spark, d).withColumn("dominant_sentiment", F.col("sentiment")), "dist").select("doc_id", "dominant_sentiment")


NORMAL = "t0 AS (SELECT *, list_sum(list_transform(positive_tones, lambda x: x.share)) AS t FROM an), t1 AS (SELECT *, list_transform(positive_tones, lambda x: round(x.share / t, 6)) AS s FROM t0), t2 AS (SELECT *, CASE WHEN len(s) = 0 THEN s WHEN t > 0 AND t <= 1.25 THEN list_append(s[:-2], round(1.0 - coalesce(list_sum(s[:-2]), 0), 6)) END AS shares FROM t1)"


@query(f"{AN}, {NORMAL} SELECT doc_id, array_to_string(list_transform(shares, lambda x: CAST(CAST(round(x * 1000000) AS BIGINT) AS VARCHAR)), ',') AS shares_millionths FROM t2")
def q_tone_normalize(spark, d):
    tones = A.normalize_tones(F.col("positive_tones"))
    return views.analyses(spark, d).select("doc_id", F.array_join(F.transform(tones, lambda t: F.round(t["share"] * 1_000_000).cast("long").cast("string")), ",").alias("shares_millionths"))


def _tone_tests(name: str, labels: tuple, polarity: str) -> str:
    names, total = f"list_transform({name}, lambda x: x.tone)", f"list_sum(list_transform({name}, lambda x: x.share))"
    known = ", ".join(f"'{x}'" for x in labels)
    return (
        f"CASE WHEN len({name}) = 0 AND {polarity} > 0.01 THEN '{name}_missing' END, CASE WHEN len(list_distinct({names})) < len({name}) THEN '{name}_repeated' END, "
        f"CASE WHEN len(list_filter({names}, lambda x: x NOT IN ({known}))) > 0 THEN '{name}_unknown' END, CASE WHEN len({name}) > 0 AND abs({total} - 1) > 0.01 THEN '{name}_sum' END"
    )


@query(
    f"{AN}, s AS (SELECT *, CASE sentiment WHEN 'positive' THEN p WHEN 'neutral' THEN u WHEN 'negative' THEN n END AS share FROM an) SELECT doc_id, array_to_string(list_filter([CASE WHEN abs(p + u + n - 1) > 0.01 THEN 'distribution_sum' END, "
    "CASE WHEN NOT (sentiment = 'neutral' AND p = n) AND coalesce(abs(share - greatest(p, u, n)), 1) > 0.001 THEN 'dominant_not_largest' END, "
    "CASE WHEN sentiment = 'positive' AND sentiment_score <= 0 OR sentiment = 'negative' AND sentiment_score >= 0 THEN 'score_direction' END, "
    f"{_tone_tests('positive_tones', A.POSITIVE_TONES, 'p')}, {_tone_tests('negative_tones', A.NEGATIVE_TONES, 'n')}], lambda x: x IS NOT NULL), ',') AS errors FROM s"
)
def q_semantics_errors(spark, d):
    df = views.analyses(spark, d).withColumn("dominant_sentiment", F.col("sentiment"))
    return df.select("doc_id", F.array_join(A.semantics_errors(df, "dist"), ",").alias("errors"))


@query(f"{AN} SELECT doc_id, CASE WHEN schema_version = 1 AND sentiment = 'mixed' THEN CASE WHEN sentiment_score > 0 THEN 'positive' WHEN sentiment_score < 0 THEN 'negative' ELSE 'neutral' END ELSE sentiment END AS dominant_sentiment, CASE WHEN schema_version = 1 THEN CASE WHEN sentiment = 'mixed' THEN 'high' END ELSE polarization END AS polarization FROM an")
def q_version_compat(spark, d):
    return A.upgrade(views.analyses(spark, d)).select("doc_id", "dominant_sentiment", "polarization")


@query(
    f"{AN}, f AS (SELECT doc_id, list_transform(positive_tones, lambda x: x.tone || ' ' || CAST(round_even(x.share * 100, 0) AS BIGINT) || '%' || CASE WHEN len(list_filter(x.drivers, lambda y: trim(y) <> '')) > 0 "
    "THEN ' (' || array_to_string(list_transform(list_filter(x.drivers, lambda y: trim(y) <> ''), lambda y: trim(y)), '; ') || ')' ELSE '' END) AS parts FROM an) SELECT doc_id, CASE WHEN len(parts) = 0 THEN '-' ELSE array_to_string(parts, ' · ') END AS tones FROM f"
)
def q_tone_format(spark, d):
    return views.analyses(spark, d).select("doc_id", A.format_tones(F.col("positive_tones")).alias("tones"))


#: Results with faults by doc_id % 31, as SQL over the sound JSON text ``j`` that both engines share.
FAULTS = """CASE doc_id % 31 WHEN 1 THEN '{' WHEN 2 THEN '[]' WHEN 3 THEN '{"summary":""}' WHEN 4 THEN concat(left(j, length(j) - 1), ',"mood":1}')
  WHEN 5 THEN replace(j, '"summary":"', concat('"summary":"', repeat('x', 401))) WHEN 6 THEN replace(j, '"topics":[', '"topics":["a","b","c",')
  WHEN 7 THEN replace(j, '"keywords":[', concat('"keywords":["', repeat('k', 61), '",')) WHEN 8 THEN replace(j, '"neutral":', '"other":1,"neutral":')
  WHEN 9 THEN replace(j, '"drivers":', '"mood":"x","drivers":') WHEN 10 THEN replace(j, '"share":', '"share":1') WHEN 11 THEN replace(j, '"drivers":["', '"drivers":["","')
  WHEN 12 THEN replace(j, '"hope"', '"joy"') WHEN 13 THEN replace(j, '"polarization_score"', '"polarisation_score"') ELSE j END"""


def _json(df):
    """Analyses as JSON texts, some broken."""
    names = ["polarization", "polarization_score", "topics", "keywords", "positive_tones", "negative_tones"]
    j = F.to_json(F.struct(F.col("dist").alias("estimated_sentiment_distribution"), *names, F.concat(F.lit("Summary "), F.col("doc_id")).alias("summary")), {"ignoreNullFields": "false"})
    return df.select("doc_id", j.alias("j")).select("doc_id", F.expr(FAULTS).alias("raw"))


def _schema_sql() -> str:
    """A row a result with ``ok``: a struct of the rules, by DuckDB's own JSON parser."""
    texts = lambda x, most, chars, least=0: f"json_type({x}) = 'ARRAY' AND json_array_length({x}) BETWEEN {least} AND {most} AND len(list_filter(CAST({x} AS VARCHAR[]), lambda e: NOT length(e) BETWEEN 1 AND {chars})) = 0"
    number = lambda x: f"TRY_CAST({x} AS DOUBLE) BETWEEN 0 AND 1"

    def tones(name, labels):
        known = ", ".join(f"'{x}'" for x in labels)
        good = f"list_sort(json_keys(e)) = ['drivers', 'share', 'tone'] AND (e->>'$.tone') IN ({known}) AND {number('e->>' + chr(39) + '$.share' + chr(39))} AND {texts('(e->' + chr(39) + '$.drivers' + chr(39) + ')', *A.DRIVERS, least=1)}"
        at = f"(j->'$.{name}')"
        return f"json_type({at}) = 'ARRAY' AND json_array_length({at}) <= {A.TONES} AND len(list_filter(CAST({at} AS JSON[]), lambda e: NOT coalesce({good}, false))) = 0"

    fields = ", ".join(f"'{f}'" for f in sorted(A.FIELDS_V3))
    spread = "(j->'$.estimated_sentiment_distribution')"
    rules = {
        "not_an_object": "json_type(j) = 'OBJECT'",
        "missing_fields": f"json_type(j) = 'OBJECT' AND len(list_filter([{fields}], lambda f: NOT list_contains(json_keys(j), f))) = 0",
        "unknown_fields": f"json_type(j) IS DISTINCT FROM 'OBJECT' OR len(list_filter(json_keys(j), lambda f: f NOT IN ({fields}))) = 0",
        "estimated_sentiment_distribution": f"list_sort(json_keys({spread})) = ['negative', 'neutral', 'positive'] AND " + " AND ".join(number(f"({spread}->>'$.{k}')") for k in A.SENTIMENTS),
        "polarization": "(j->>'$.polarization') IN ('low', 'medium', 'high')",
        "polarization_score": number("(j->>'$.polarization_score')"),
        **{name: texts(f"(j->'$.{name}')", *bounds) for name, bounds in A.LISTS.items()},
        "summary": f"length(j->>'$.summary') BETWEEN 1 AND {A.SUMMARY}",
        "positive_tones": tones("positive_tones", A.POSITIVE_TONES),
        "negative_tones": tones("negative_tones", A.NEGATIVE_TONES),
    }
    sound = "to_json({'estimated_sentiment_distribution': {'positive': p, 'neutral': u, 'negative': n}, 'polarization': polarization, 'polarization_score': polarization_score, 'topics': topics, 'keywords': keywords, 'positive_tones': positive_tones, 'negative_tones': negative_tones, 'summary': 'Summary ' || doc_id})"
    told = ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{name}' END" for name, ok in rules.items())
    return f"{AN}, j0 AS (SELECT doc_id, CAST({sound} AS VARCHAR) AS j FROM an), j1 AS (SELECT doc_id, {FAULTS} AS raw FROM j0), j2 AS (SELECT doc_id, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS j FROM j1), er AS (SELECT doc_id, list_filter([{told}], lambda x: x IS NOT NULL) AS errors FROM j2)"


@query(f"{_schema_sql()} SELECT error, count(*) AS row_count FROM (SELECT unnest(errors) AS error FROM er) GROUP BY error")
def q_result_validation_counts(spark, d):
    return _json(views.analyses(spark, d)).select(F.explode(A.schema_errors(F.col("raw"))).alias("error")).groupBy("error").agg(F.count("*").alias("row_count"))


@query(f"{_schema_sql()} SELECT doc_id, array_to_string(errors, ',') AS errors FROM er")
def q_result_schema_errors(spark, d):
    return _json(views.analyses(spark, d)).select("doc_id", F.array_join(A.schema_errors(F.col("raw")), ",").alias("errors"))


#: Answers of the three versions made of ``documents``, with faults by doc_id, as SQL that both engines share.
_SAID = """concat('"topics":[', CASE doc_id % 11 WHEN 0 THEN '' WHEN 1 THEN '"a","b","c","d","e","f"' WHEN 2 THEN '"a",7' ELSE concat('"', coalesce(lang, 'x'), '"') END, '],"keywords":', CASE doc_id % 13 WHEN 0 THEN '"one"' WHEN 1 THEN '[""]' ELSE concat('["', coalesce(source, 'x'), '"]') END,
  ',"summary":', CASE doc_id % 17 WHEN 0 THEN '""' WHEN 1 THEN 'null' WHEN 2 THEN concat('"', repeat('s', 401), '"') ELSE concat('"', w, '"') END)"""
_SPREAD = """concat('"estimated_sentiment_distribution":{"positive":', CASE doc_id % 19 WHEN 0 THEN '1.5' WHEN 1 THEN '"0"' ELSE '0.5' END, ',"neutral":0.25,"negative":0', CASE doc_id % 23 WHEN 0 THEN ',"more":1' ELSE '' END, '},"polarization":"', CASE doc_id % 7 WHEN 0 THEN 'extreme' ELSE 'low' END, '","polarization_score":', CASE doc_id % 29 WHEN 0 THEN 'true' ELSE '1' END)"""
_TONED = """concat('"positive_tones":[', CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '{"tone":"anger","share":1,"drivers":["x"]}' WHEN 2 THEN '{"tone":"hope","share":1,"drivers":[]}' WHEN 3 THEN '{"tone":"hope","share":1}' ELSE '{"tone":"hope","share":0.5,"drivers":["x","y"]},{"tone":"trust","share":0.5,"drivers":["z"]}' END, '],"negative_tones":', CASE doc_id % 31 WHEN 0 THEN '{}' ELSE '[]' END)"""
ANSWERS = f"""CASE doc_id % 3
  WHEN 0 THEN concat('{{"sentiment":"', CASE doc_id % 4 WHEN 0 THEN 'mixed' WHEN 1 THEN 'odd' ELSE 'neutral' END, '","sentiment_score":', CASE doc_id % 5 WHEN 0 THEN '-1.01' ELSE '-1' END, ',', {_SAID}, CASE doc_id % 37 WHEN 0 THEN ',"more":1' ELSE '' END, '}}')
  WHEN 1 THEN concat('{{"dominant_sentiment":"', CASE doc_id % 4 WHEN 0 THEN 'mixed' ELSE 'neutral' END, '"', CASE doc_id % 5 WHEN 0 THEN '' ELSE ',"sentiment_score":0' END, ',', {_SPREAD}, ',', {_SAID}, CASE doc_id % 37 WHEN 0 THEN '' ELSE '}}' END)
  ELSE concat('{{', {_SPREAD}, ',', {_SAID}, ',', {_TONED}, '}}') END"""


def _versions_sql() -> str:
    """The rules of the versions over DuckDB's own JSON types."""
    quoted = lambda names: ", ".join(f"'{n}'" for n in names)
    number = lambda p, low, high: f"coalesce(json_type({p}) IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND CAST({p} AS DOUBLE) BETWEEN {low} AND {high}, false)"
    choice = lambda p, labels: f"coalesce(json_type({p}) = 'VARCHAR' AND {p}->>'$' IN ({quoted(labels)}), false)"
    word = lambda p, chars: f"coalesce(json_type({p}) = 'VARCHAR' AND length({p}->>'$') BETWEEN 1 AND {chars}, false)"
    items = lambda p, most, least, test: f"coalesce(json_type({p}) = 'ARRAY' AND json_array_length({p}) BETWEEN {least} AND {most} AND len(list_filter(json_extract({p}, '$[*]'), lambda e: NOT ({test}))) = 0, false)"
    only = lambda p, names: f"coalesce(json_type({p}) = 'OBJECT' AND list_sort(json_keys({p})) = list_sort([{quoted(names)}]), false)"
    at = lambda name: f"(j->'$.{name}')"
    texts = {n: items(at(n), most, 0, word("e", chars)) for n, (most, chars) in A.LISTS.items()} | {"summary": word(at("summary"), A.SUMMARY)}
    shares = " AND ".join(number(f"({at('estimated_sentiment_distribution')}->'$.{k}')", 0, 1) for k in A.SENTIMENTS)
    spread = {"estimated_sentiment_distribution": f"{only(at('estimated_sentiment_distribution'), A.SENTIMENTS)} AND {shares}", "polarization": choice(at("polarization"), A.POLARIZATIONS), "polarization_score": number(at("polarization_score"), 0, 1)}
    drivers = f"coalesce(json_type(e->'$.drivers') = 'ARRAY' AND json_array_length(e->'$.drivers') BETWEEN 1 AND {A.DRIVERS[0]}, false)"  # all are texts here
    tones = lambda n, labels: items(at(n), A.TONES, 0, f"{only('e', ('tone', 'share', 'drivers'))} AND {choice('(e->' + repr('$.tone') + ')', labels)} AND {number('(e->' + repr('$.share') + ')', 0, 1)} AND {drivers}")
    versions = [
        {"sentiment": choice(at("sentiment"), (*A.SENTIMENTS, "mixed")), "sentiment_score": number(at("sentiment_score"), -1, 1), **texts},
        {"dominant_sentiment": choice(at("dominant_sentiment"), A.SENTIMENTS), "sentiment_score": number(at("sentiment_score"), -1, 1), **spread, **texts},
        {**spread, **texts, "positive_tones": tones("positive_tones", A.POSITIVE_TONES), "negative_tones": tones("negative_tones", A.NEGATIVE_TONES)},
    ]
    parts = []
    for k, rules in enumerate(versions):
        tests = {"not_an_object": "ok", "missing_fields": f"len(list_filter([{quoted(rules)}], lambda x: NOT list_contains(json_keys(j), x))) = 0", "unknown_fields": f"len(list_filter(json_keys(j), lambda x: x NOT IN ({quoted(rules)}))) = 0", **rules}
        cases = ", ".join(f"CASE WHEN NOT ({t}) THEN '{n}' END" for n, t in tests.items())
        parts.append(f"SELECT doc_id, {k + 1} AS version, array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), ',') AS errors FROM o WHERE doc_id % 3 = {k}")
    return f"WITH d AS (SELECT doc_id, lang, source, left(regexp_replace(text, '[^A-Za-z ]', '', 'g') || 'x', 300) AS w FROM documents), r AS (SELECT doc_id, {ANSWERS} AS raw FROM d), o AS (SELECT doc_id, json_valid(raw) AS ok, CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END::JSON AS j FROM r) " + " UNION ALL ".join(parts)


@query(_versions_sql())
def q_schema_versions(spark, d):
    """Answers of all three versions of the contract, made of documents, against schemas compiled from their documents."""
    rows = views.load(spark, d, "documents").selectExpr("doc_id", "lang", "source", "left(concat(regexp_replace(text, '[^A-Za-z ]', ''), 'x'), 300) AS w").select("doc_id", F.expr(ANSWERS).alias("raw"))
    version = (F.col("doc_id") % 3 + 1).cast("int")
    found = [A.schema_errors(F.col("raw"), v) for v in (1, 2, 3)]
    return rows.select("doc_id", version.alias("version"), F.array_join(F.when(version == 1, found[0]).when(version == 2, found[1]).otherwise(found[2]), ",").alias("errors"))


@query(f"{AN} SELECT doc_id, array_to_string(list_transform(list_sort(list_transform(positive_tones, lambda x, i: {{'s': -x.share, 'i': i, 't': x.tone}}))[1:2], lambda y: y.t), ',') AS tones FROM an")
def q_top_tones(spark, d):
    """Two of the three tones, so that some are left out."""
    top = A.top_tones(F.col("positive_tones"), 2)
    return views.analyses(spark, d).select("doc_id", F.array_join(F.transform(top, lambda t: t["tone"]), ",").alias("tones"))


@query(
    f"{AN} SELECT doc_id, array_to_string(list_filter([CASE WHEN polarization NOT IN ('low', 'medium', 'high') THEN 'polarization' END, CASE WHEN polarization_score > 1 THEN 'polarization_score' END], lambda x: x IS NOT NULL), ',') AS violations FROM an WHERE polarization = 'extreme' OR polarization_score > 1"
)
def q_constraint_violations(spark, d):
    df = contract.constraint_violations(views.analyses(spark, d)).where(F.size("violations") > 0)
    return df.select("doc_id", F.array_join("violations", ",").alias("violations"))


GATE = """l AS (SELECT doc_id, k, unnest(v) AS v, generate_subscripts(v, 1) AS i FROM (SELECT doc_id, 'topics' AS k, topics AS v FROM an UNION ALL SELECT doc_id, 'keywords', keywords FROM an)),
c AS (SELECT *, trim(regexp_replace(replace(replace(replace(v, '–', '-'), '—', '-'), '’', ''''), '\\s+', ' ', 'g')) AS c FROM l),
r AS (SELECT *, CASE WHEN c = '' THEN 'empty_after_normalization' WHEN regexp_matches(c, '[^\\x00-\\x7f]') THEN 'non_ascii_character' WHEN NOT regexp_full_match(c, '[A-Za-z0-9][A-Za-z0-9 &''()+,./:-]*') THEN 'disallowed_character'
  WHEN regexp_matches(c, '(?i)\\b(?:keep short|return only|requested json|do not infer|system prompt)\\b') THEN 'prompt_meta_phrase' WHEN regexp_matches(c, '[A-Za-z0-9]{24,}') THEN 'suspicious_alphanumeric_run'
  WHEN len(regexp_extract_all(c, '[A-Za-z0-9]+(?:''[A-Za-z0-9]+)?')) > CASE k WHEN 'topics' THEN 8 ELSE 6 END THEN 'too_many_words' END AS reason FROM c),
g AS (SELECT *, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY doc_id, k, lower(c), reason IS NULL ORDER BY i) END AS turn FROM r)"""


@query(f"{AN}, {GATE}, o AS (SELECT doc_id, count(*) FILTER (reason IS NOT NULL OR turn > 1) AS removed_labels, coalesce(string_agg(c, '|' ORDER BY i) FILTER (k = 'topics' AND turn = 1), '') AS topics, coalesce(string_agg(c, '|' ORDER BY i) FILTER (k = 'keywords' AND turn = 1), '') AS keywords, bool_or(reason IS NOT NULL OR turn > 1 OR c <> v) AS m FROM g GROUP BY doc_id) SELECT doc_id, removed_labels, topics, keywords, CASE WHEN m THEN 'modified' ELSE 'passed' END AS gate_status FROM o")
def q_label_gate(spark, d):
    df = labels.gate(views.analyses(spark, d))
    return df.select("doc_id", F.col("removed_labels").cast("long").alias("removed_labels"), F.array_join("topics", "|").alias("topics"), F.array_join("keywords", "|").alias("keywords"), "gate_status")


@query(f"{AN}, {GATE}, x AS (SELECT reason FROM g WHERE reason IS NOT NULL UNION ALL SELECT 'duplicate_after_normalization' FROM g WHERE turn > 1 UNION ALL SELECT 'unicode_or_whitespace_normalized' FROM g WHERE c <> v) SELECT reason, count(*) AS row_count FROM x GROUP BY reason")
def q_label_gate_reasons(spark, d):
    return labels.gate(views.analyses(spark, d)).select(F.explode("gate_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("row_count"))


@query(f"{AN} SELECT event_id, prompt_version, arg_max(sentiment, doc_id) AS sentiment FROM (SELECT event_id, prompt_version, sentiment, doc_id FROM an UNION ALL SELECT event_id, prompt_version, 'neutral', doc_id + 1000000 FROM an WHERE doc_id % 10 = 0) GROUP BY ALL")
def q_analysis_upsert(spark, d):
    from ..operators.dedup import upsert

    an = views.analyses(spark, d).select("event_id", "prompt_version", "sentiment", "doc_id")
    return upsert(an, an.where("doc_id % 10 = 0").withColumn("sentiment", F.lit("neutral")), ["event_id", "prompt_version"], [F.col("doc_id")], [], ["sentiment"])


@query("WITH m AS (SELECT 'b' || (doc_id % 7) AS llm_batch_id, CASE WHEN doc_id % 7 = 6 THEN ' ' ELSE '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') END AS period, CASE WHEN doc_id % 7 < 5 THEN source END AS g FROM documents) SELECT llm_batch_id, CASE WHEN min(nullif(trim(period), '')) = max(nullif(trim(period), '')) THEN min(period) ELSE min(nullif(trim(period), '')) || ' ~ ' || max(nullif(trim(period), '')) END AS period, coalesce(array_to_string(list_transform(list_sort(list(DISTINCT g) FILTER (g IS NOT NULL)), lambda x: CASE x WHEN 'src1' THEN 'One' ELSE x END), ', '), '') AS groups FROM m GROUP BY llm_batch_id")
def q_batch_context(spark, d):
    m = views.load(spark, d, "documents").selectExpr("concat('b', CAST(doc_id % 7 AS STRING)) AS llm_batch_id", "CASE WHEN doc_id % 7 = 6 THEN ' ' ELSE concat('2024-01-', lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0')) END AS period", "CASE WHEN doc_id % 7 < 5 THEN source END AS group_name")
    return reconcile.batch_context(m, {"src1": "One"})


DAILY = "dl AS (SELECT DATE '2024-01-01' + CAST(k AS INT) AS day, CASE WHEN k % 9 = 0 THEN 'pending' ELSE 'completed' END AS status, count(*) AS validated_rows, sum(doc_id % 3) AS failed_rows, sum(n_chars) AS input_tokens, sum(n_chars // 10) AS output_tokens, sum(doc_id % 5) AS cached_input_tokens, CASE WHEN k > 3 THEN sum(doc_id % 7) END AS reasoning_output_tokens, CAST(sum(doc_id % 11) * 0.0001 AS DECIMAL(18,6)) AS cost_usd FROM (SELECT *, doc_id % 40 AS k FROM documents) GROUP BY k)"


@query(f"WITH {DAILY} SELECT 31 AS requested_days, CAST(count(*) FILTER (status = 'completed') AS BIGINT) AS completed_days, 31 - count(*) FILTER (status = 'completed') AS pending_days, {', '.join(f'CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in ('validated_rows', *reconcile.DAILY_SUMS))}, CAST(sum(cost_usd) AS DOUBLE) AS cost_usd FROM dl WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-02-02'")
def q_daily_report(spark, d):
    docs = views.load(spark, d, "documents").withColumn("k", (F.col("doc_id") % 40).cast("int"))
    daily = docs.groupBy(F.date_add(F.to_date(F.lit("2024-01-01")), F.col("k")).alias("day"), F.when(F.col("k") % 9 == 0, "pending").otherwise("completed").alias("status")).agg(
        F.count("*").alias("validated_rows"), F.sum(F.col("doc_id") % 3).alias("failed_rows"), F.sum("n_chars").alias("input_tokens"), F.sum(F.expr("n_chars div 10")).alias("output_tokens"), F.sum(F.col("doc_id") % 5).alias("cached_input_tokens"),
        F.sum(F.when(F.col("k") > 3, F.col("doc_id") % 7)).alias("reasoning_output_tokens"), (F.sum(F.col("doc_id") % 11) * F.lit("0.0001").cast("decimal(8,4)")).cast("decimal(18,6)").alias("cost_usd"),
    )
    return reconcile.daily_report(daily, "2024-01-03", "2024-02-02").withColumn("cost_usd", F.col("cost_usd").cast("double"))


@query(f"{RES} SELECT custom_id, CAST(DATE '2024-01-01' + CAST(man.doc_id % 31 AS INT) AS VARCHAR) AS day, coalesce(input_tokens, -1) AS input_tokens FROM man JOIN res USING (custom_id) WHERE turn = 0")
def q_artifact_day_results(spark, d):
    """Requests that have results, by the day of their manifest, and those requests' first results."""
    got = views.results(spark, d).where("turn = 0")
    asked = views.requests(spark, d).join(got.select("custom_id"), "custom_id", "left_semi").withColumn("day", F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("doc_id") % 31).cast("int")).cast("string"))
    known = got.join(views.requests(spark, d).select("custom_id"), "custom_id", "left_semi")
    return reconcile.day_results(asked, known).select("custom_id", "day", F.coalesce("input_tokens", F.lit(-1).cast("long")).alias("input_tokens"))


@query(f"{AN} SELECT 'run-1' AS run_id, count(*) AS input_rows, count(*) FILTER (sentiment = 'mixed') AS mixed_rows FROM an")
def q_snapshot_latest(spark, d):
    """The latest of two runs' snapshots, each a nested row."""
    an = views.analyses(spark, d)
    accounts = an.agg(F.count("*").alias("input_rows"), F.count("*").alias("unique_rows"), F.lit(0).cast("long").alias("duplicate_rows"), F.lit(0).cast("long").alias("rejected_rows"))
    runs = [serving.snapshot(f"run-{i}", accounts, serving.summary(an, "all"), f"2024-01-0{i + 1}") for i in range(2)]
    return serving.latest(runs[0].unionByName(runs[1]), 1).select("run_id", "accounting.input_rows", "summary.mixed_rows")
