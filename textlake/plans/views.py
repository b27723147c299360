"""Views of the driver's tables in the engine's own shapes, each as a DataFrame and as SQL.

The tables' texts have no defects of most kinds, so ``doc_id % 100`` puts in some, as the synthetic
generator does. Every view is a projection; the SQL twin is a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Texts by doc_id % 100, as SQL that Spark and DuckDB share (fixed values of the generator).
DEFECTS = """CASE doc_id % 100
  WHEN 5 THEN concat(text, {zero}) WHEN 10 THEN repeat('x', 150)
  WHEN 15 THEN 'https://example.com/a/bbbbbbbbbbbbb https://example.com/b/ccccccccc'
  WHEN 20 THEN concat(text, ' mail a.b@example.com') WHEN 25 THEN concat('a', repeat({mark}, 10))
  WHEN 30 THEN repeat('abcdefghij ', 500) WHEN 35 THEN repeat('😀', 16385) WHEN 40 THEN '[removed]'
  WHEN 45 THEN concat({bell}, text) WHEN 50 THEN concat('cafe', {mark}, ' ', text)
  WHEN 55 THEN concat({tab}, {newline}) WHEN 60 THEN ' [Deleted] ' WHEN 65 THEN concat(' ', text, ' ')
  ELSE text END"""
_SPARK = {"zero": r"'​'", "mark": r"'́'", "bell": r"'\u0007'", "tab": r"'\t'", "newline": r"'\n'"}
_DUCK = {"zero": "chr(8203)", "mark": "chr(769)", "bell": "chr(7)", "tab": "chr(9)", "newline": "chr(10)"}

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text events from ``documents``; every fiftieth repeats the id of the one before."""
    docs = load(spark, sf_dir, "documents")
    sid = "doc_id - CASE WHEN doc_id % 50 = 0 AND doc_id > 0 THEN 1 ELSE 0 END"
    return docs.selectExpr(
        "doc_id",
        f"sha2(concat('reddit:', CAST({sid} AS STRING)), 256) AS event_id",
        "CASE WHEN doc_id % 2 = 0 THEN 'news' ELSE 'comment' END AS source_type",
        "CASE WHEN doc_id % 2 = 0 THEN 'web_news' ELSE 'reddit' END AS source_name",
        "date_format(timestamp_seconds(1704067200 + doc_id * 420), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS event_time",
        "date_format(timestamp_seconds(1704070800 + doc_id * 420), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS collected_at",
        "lang AS language",
        "CASE WHEN doc_id % 2 = 0 THEN concat('Title ', text) END AS title",
        f"{DEFECTS.format(**_SPARK)} AS text",
        "CASE WHEN doc_id % 2 = 0 THEN concat('https://www.example.com/n/', CAST(doc_id AS STRING)) END AS url",
        "CASE WHEN doc_id % 2 = 1 THEN CASE WHEN doc_id % 3 = 0 THEN upper(source) ELSE source END END AS community",
        "doc_id % 41 - 10 AS engagement",
        "1 AS schema_version",
        "concat('run-', CAST(doc_id % 3 AS STRING)) AS run_id",
        "concat('g', CAST(doc_id div 2 % 4 AS STRING), ', g', CAST(doc_id div 8 % 4 AS STRING)) AS topic_groups",
    )


EVENTS_SQL = f"""ev AS (SELECT doc_id,
  sha256('reddit:' || (doc_id - CASE WHEN doc_id % 50 = 0 AND doc_id > 0 THEN 1 ELSE 0 END)) AS event_id,
  CASE WHEN doc_id % 2 = 0 THEN 'news' ELSE 'comment' END AS source_type,
  CASE WHEN doc_id % 2 = 0 THEN 'web_news' ELSE 'reddit' END AS source_name,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id * 7), '%Y-%m-%dT%H:%M:%SZ') AS event_time,
  strftime(TIMESTAMP '2024-01-01 01:00:00' + to_minutes(doc_id * 7), '%Y-%m-%dT%H:%M:%SZ') AS collected_at,
  lang AS language,
  CASE WHEN doc_id % 2 = 0 THEN 'Title ' || text END AS title,
  {DEFECTS.format(**_DUCK)} AS text,
  CASE WHEN doc_id % 2 = 0 THEN 'https://www.example.com/n/' || doc_id END AS url,
  CASE WHEN doc_id % 2 = 1 THEN CASE WHEN doc_id % 3 = 0 THEN upper(source) ELSE source END END AS community,
  doc_id % 41 - 10 AS engagement, 1 AS schema_version, 'run-' || (doc_id % 3) AS run_id,
  'g' || (doc_id // 2 % 4) || ', g' || (doc_id // 8 % 4) AS topic_groups FROM documents)"""

#: Fields of a message by doc_id % 97, where they differ from the event's, as SQL that both engines share.
_BROKEN = {
    "event_id": "CASE doc_id % 97 WHEN 11 THEN 'XYZ' ELSE event_id END",
    "source_type": "CASE doc_id % 97 WHEN 17 THEN 'blog' ELSE source_type END",
    "source_name": "CASE doc_id % 97 WHEN 19 THEN 'usenet' ELSE source_name END",
    "event_time": "CASE doc_id % 97 WHEN 13 THEN 'yesterday' ELSE event_time END",
    "collected_at": "CASE doc_id % 97 WHEN 13 THEN NULL ELSE collected_at END",
    "language": "CASE doc_id % 97 WHEN 23 THEN ' ' ELSE language END",
    "title": "title",
    "text": "CASE doc_id % 97 WHEN 29 THEN NULL ELSE text END",
    "url": "url",
    "community": "community",
    "engagement": "engagement",
    "schema_version": "CASE doc_id % 97 WHEN 31 THEN 2 ELSE 1 END",
}
_RAW = """CASE doc_id % 97 WHEN 3 THEN 'not-json' WHEN 5 THEN concat('{{"event_id":"', event_id, '"}}') WHEN 7 THEN concat(left(j, length(j) - 1), ',"extra":1}}')
  WHEN 41 THEN replace(j, concat('"engagement":', engagement), '"engagement":"x"') WHEN 43 THEN '[1]' WHEN 47 THEN NULL WHEN 53 THEN '' ELSE j END"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with the events as JSON, some of them broken; three partitions."""
    ev = events(spark, sf_dir)
    meta = "CASE doc_id % 97 WHEN 37 THEN NULL ELSE map('pipeline_run_id', run_id, 'analysis_date', left(event_time, 10), 'topic_groups', topic_groups) END AS metadata"
    fields = ev.selectExpr("doc_id", "event_id AS _id", "engagement AS _eng", *[f"{v} AS {k}" for k, v in _BROKEN.items()], meta)
    names = [*_BROKEN, "metadata"]
    raw = fields.select("doc_id", F.col("_id").alias("event_id"), F.col("_eng").alias("engagement"), F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("j"))
    return raw.select(
        F.col("doc_id").cast("string").cast("binary").alias("key"),
        F.expr(_RAW.format()).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.expr("CAST(doc_id % 3 AS INT)").alias("partition"),
        F.expr("doc_id div 3").alias("offset"),
        F.expr("TIMESTAMP'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(doc_id * 7 AS INT))").alias("timestamp"),
    )


_JSON = ", ".join(f"'{k}', {v}" for k, v in _BROKEN.items())
MESSAGES_SQL = f"""{EVENTS_SQL},
mj AS (SELECT doc_id, event_id, engagement, CAST(json_object({_JSON}, 'metadata', CASE doc_id % 97 WHEN 37 THEN NULL
   ELSE json_object('pipeline_run_id', run_id, 'analysis_date', left(event_time, 10), 'topic_groups', topic_groups) END) AS VARCHAR) AS j FROM ev),
msg AS (SELECT doc_id, {_RAW.format()} AS value, 'events' AS topic, CAST(doc_id % 3 AS INT) AS part, doc_id // 3 AS off FROM mj),
ok AS (SELECT *, coalesce(trim(value), '') <> '' AS filled, CASE WHEN coalesce(trim(value), '') <> '' AND json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END AS obj FROM msg),
parsed AS (SELECT *, filled AND NOT (obj AND coalesce(json_type(CASE WHEN obj THEN value ELSE '{{}}' END, '$.engagement') IN ('UBIGINT', 'BIGINT', 'NULL'), true)) AS corrupt,
   CASE WHEN obj THEN json_keys(value) ELSE [] END AS keys, CASE WHEN obj THEN value ELSE '{{}}' END AS v FROM ok),
fields AS (SELECT *, v->>'$.event_id' AS event_id, v->>'$.source_type' AS source_type, v->>'$.source_name' AS source_name, v->>'$.event_time' AS event_time,
   v->>'$.collected_at' AS collected_at, v->>'$.language' AS language, v->>'$.title' AS title, v->>'$.text' AS text, v->>'$.community' AS community, v->>'$.url' AS url, v->>'$.metadata.pipeline_run_id' AS run_id,
   v->>'$.metadata.analysis_date' AS analysis_date, try_cast(v->>'$.schema_version' AS INT) AS schema_version, coalesce(json_type(v, '$.metadata') = 'OBJECT', false) AS has_meta,
   ['event_id','source_type','source_name','event_time','collected_at','language','title','text','url','community','engagement','schema_version','metadata'] AS want FROM parsed),
con AS (SELECT *, list_filter([
   CASE WHEN corrupt THEN 'MALFORMED_JSON' END,
   CASE WHEN len(list_filter(want, lambda x: NOT list_contains(keys, x))) > 0 THEN 'MISSING_FIELDS' END,
   CASE WHEN len(list_filter(keys, lambda x: NOT list_contains(want, x))) > 0 THEN 'UNEXPECTED_FIELDS' END,
   CASE WHEN NOT coalesce(regexp_full_match(event_id, '[a-f0-9]{{64}}'), false) THEN 'INVALID_EVENT_ID' END,
   CASE WHEN NOT coalesce(source_type IN ('news', 'comment'), false) THEN 'INVALID_SOURCE_TYPE' END,
   CASE WHEN NOT coalesce(source_name IN ('gdelt', 'reddit', 'web_news'), false) THEN 'INVALID_SOURCE_NAME' END,
   CASE WHEN try_cast(event_time AS TIMESTAMP) IS NULL THEN 'INVALID_EVENT_TIME' END,
   CASE WHEN try_cast(collected_at AS TIMESTAMP) IS NULL THEN 'INVALID_COLLECTED_AT' END,
   CASE WHEN coalesce(trim(language), '') = '' THEN 'MISSING_LANGUAGE' END,
   CASE WHEN coalesce(trim(text, ' '), '') = '' THEN 'MISSING_TEXT' END,
   CASE WHEN schema_version IS DISTINCT FROM 1 THEN 'UNSUPPORTED_SCHEMA_VERSION' END,
   CASE WHEN NOT has_meta THEN 'MISSING_METADATA' END], lambda x: x IS NOT NULL) AS errors FROM fields)"""


def quality_sql(source: str, text: str = "text", out: str = "q") -> str:
    """CTEs that end in ``out``: rows of ``source`` with the quality figures but zlib's, and flags, reason, status, route."""
    from ..functions.quality import combining_class

    control, white = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]", r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
    return rf"""{out}0 AS (SELECT *, {text} AS t0 FROM {source}),
{out}1 AS (SELECT *, regexp_replace(nfc_normalize(regexp_replace(t0, '{control}|[\x{{200b}}\x{{2060}}\x{{feff}}]', '', 'g')), '\A{white}+|{white}+\z', '', 'g') AS clean FROM {out}0),
{out}2 AS (SELECT *, length(t0) AS chars, strlen(t0) AS bytes, len(regexp_extract_all(t0, '{control}')) AS controls, len(regexp_extract_all(t0, '[\x{{200b}}\x{{2060}}\x{{feff}}]')) AS zero_width,
   coalesce(list_max(list_transform(regexp_extract_all(clean, '{combining_class()}+'), lambda m: length(m))), 0) AS marks,
   regexp_extract_all(clean, '(?i)(?:https?://|www\.)[^\s\x{{85}}\p{{Z}}]+') AS urls,
   regexp_replace(clean, '{white}', '', 'g') AS compact,
   regexp_matches(clean, '(?i)(^|[^\p{{L}}\p{{M}}\p{{N}}_.+-])[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{{2,}}([^\p{{L}}\p{{M}}\p{{N}}_.-]|$)') OR regexp_matches(clean, '(^|[^0-9])\+?[0-9][0-9 ()-]{{7,}}[0-9]([^0-9]|$)') AS pii FROM {out}1),
{out}3 AS (SELECT *, len(urls) AS url_count, CASE WHEN clean = '' THEN 0 ELSE round(coalesce(list_sum(list_transform(urls, lambda u: length(u))), 0) / length(clean), 4) END AS url_ratio FROM {out}2),
{out}4 AS (SELECT *, list_filter([
   CASE WHEN lower(regexp_replace(t0, '\A{white}+|{white}+\z', '', 'g')) IN ('[deleted]', '[removed]') THEN 'SOURCE_TOMBSTONE' END, CASE WHEN clean = '' THEN 'EMPTY_AFTER_NORMALIZATION' END,
   CASE WHEN chars > 5000 THEN 'EXCESSIVE_LENGTH' END, CASE WHEN bytes > 65536 THEN 'EXCESSIVE_UTF8_BYTES' END, CASE WHEN controls > 0 THEN 'CONTROL_CHARACTERS' END,
   CASE WHEN zero_width > 0 THEN 'ZERO_WIDTH_CHARACTERS' END, CASE WHEN marks > 8 THEN 'EXCESSIVE_COMBINING_MARKS' END,
   CASE WHEN url_count >= 2 AND url_ratio >= 0.5 THEN 'URL_HEAVY' END, CASE WHEN pii THEN 'POSSIBLE_PII' END], lambda x: x IS NOT NULL) AS flags FROM {out}3),
{out} AS (SELECT *, CASE WHEN list_contains(flags, 'SOURCE_TOMBSTONE') THEN 'SOURCE_TOMBSTONE' WHEN list_contains(flags, 'EMPTY_AFTER_NORMALIZATION') THEN 'EMPTY_AFTER_NORMALIZATION'
   WHEN chars > 20000 THEN 'EXCESSIVE_LENGTH' WHEN bytes > 65536 THEN 'EXCESSIVE_UTF8_BYTES' WHEN marks > 8 THEN 'EXCESSIVE_COMBINING_MARKS' WHEN pii THEN 'POSSIBLE_PII' END AS reason FROM {out}4)"""


def routed_sql() -> str:
    """CTEs that end in ``routed``: every message with its errors, reason and output_route."""
    return f"""{MESSAGES_SQL}, {quality_sql("con", "CASE WHEN len(errors) = 0 THEN text END")},
routed AS (SELECT *, CASE WHEN len(errors) > 0 THEN 'contract_rejected' WHEN reason IN ('SOURCE_TOMBSTONE', 'EMPTY_AFTER_NORMALIZATION') THEN 'quality_rejected' WHEN reason IS NOT NULL THEN 'quarantine' ELSE 'processed' END AS output_route FROM q)"""


def analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analyses from the ids of ``documents``: three prompt versions, tones, topics, labels with faults."""
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.expr("CAST(doc_id % 11 AS DOUBLE) / 20").alias("p"), F.expr("CAST(doc_id % 7 AS DOUBLE) / 20").alias("n"))
    tone = lambda a, b, s: f"named_struct('tone', '{a}', 'share', CAST({s} AS DOUBLE), 'drivers', array('{b}', concat(' ', source, ' ')))"
    return d.selectExpr(
        "doc_id",
        "sha2(concat('reddit:', CAST(doc_id AS STRING)), 256) AS event_id",
        "concat('req-', CAST(doc_id AS STRING)) AS custom_id",
        "element_at(array('daily-v1', 'group-daily-v2-x', 'news-comment-analysis-v3-emotional-tones'), CAST(doc_id % 3 + 1 AS INT)) AS prompt_version",
        "CAST(doc_id % 3 + 1 AS INT) AS schema_version",
        "CASE WHEN doc_id % 3 = 0 AND doc_id % 5 = 0 THEN 'mixed' WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' ELSE 'neutral' END AS sentiment",
        "round(p - n, 6) AS sentiment_score",
        "named_struct('positive', p, 'neutral', CASE WHEN doc_id % 29 = 0 THEN 0.9D ELSE round(1 - p - n, 4) END, 'negative', n) AS dist",
        "CASE WHEN doc_id % 3 > 0 THEN element_at(array('low', 'medium', 'high', 'extreme'), CAST(doc_id % 7 % 4 + 1 AS INT)) END AS polarization",
        "CASE WHEN doc_id % 3 > 0 THEN CAST(doc_id % 12 AS DOUBLE) / 10 END AS polarization_score",
        "array(lang, CASE WHEN doc_id % 9 = 0 THEN '  ' WHEN doc_id % 2 = 0 THEN ' Economy ' ELSE 'economy' END, source) AS topics",
        f"CASE WHEN doc_id % 4 = 0 THEN array() WHEN doc_id % 13 = 0 THEN array({tone('hope', 'x', 0.5)}, {tone('hope', 'y', 0.5)}) ELSE array({tone('hope', 'jobs', '(doc_id % 5 + 1) / 10.0')}, {tone('trust', 'rates', 0.3)}, {tone('relief', '', '(doc_id % 3) / 10.0')}) END AS positive_tones",
        f"CASE WHEN doc_id % 6 = 0 THEN array() WHEN doc_id % 17 = 0 THEN array({tone('envy', 'x', 1)}) ELSE array({tone('anger', 'prices', 0.625)}, {tone('sadness', 'rent', 0.375)}) END AS negative_tones",
        r"array(source, upper(source), CASE doc_id % 8 WHEN 0 THEN 'Return only this' WHEN 1 THEN repeat('ab1', 10) WHEN 2 THEN 'rates – up' WHEN 3 THEN 'café' WHEN 4 THEN 'a b c d e f g' WHEN 5 THEN '  two   blanks ' WHEN 6 THEN '#tag' ELSE ' ' END) AS keywords",
        "date_format(TIMESTAMP'2024-02-01 00:00:00' + make_dt_interval(0, 0, CAST(doc_id * 13 % 9973 AS INT)), 'yyyy-MM-dd HH:mm:ss') AS analyzed_at",
    )


def _duck_tone(a: str, b: str, s: str | float) -> str:
    return f"{{'tone': '{a}', 'share': CAST({s} AS DOUBLE), 'drivers': ['{b}', ' ' || source || ' ']}}"


ANALYSES_SQL = f"""an0 AS (SELECT doc_id, lang, source, CAST(doc_id % 11 AS DOUBLE) / 20 AS p, CAST(doc_id % 7 AS DOUBLE) / 20 AS n FROM documents),
an AS (SELECT doc_id, sha256('reddit:' || doc_id) AS event_id, 'req-' || doc_id AS custom_id, p, n,
  ['daily-v1', 'group-daily-v2-x', 'news-comment-analysis-v3-emotional-tones'][doc_id % 3 + 1] AS prompt_version, CAST(doc_id % 3 + 1 AS INT) AS schema_version,
  CASE WHEN doc_id % 3 = 0 AND doc_id % 5 = 0 THEN 'mixed' WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' ELSE 'neutral' END AS sentiment, round(p - n, 6) AS sentiment_score,
  CASE WHEN doc_id % 29 = 0 THEN 0.9 ELSE round(1 - p - n, 4) END AS u,
  CASE WHEN doc_id % 3 > 0 THEN ['low', 'medium', 'high', 'extreme'][doc_id % 7 % 4 + 1] END AS polarization, CASE WHEN doc_id % 3 > 0 THEN CAST(doc_id % 12 AS DOUBLE) / 10 END AS polarization_score,
  [lang, CASE WHEN doc_id % 9 = 0 THEN '  ' WHEN doc_id % 2 = 0 THEN ' Economy ' ELSE 'economy' END, source] AS topics,
  CASE WHEN doc_id % 4 = 0 THEN [] WHEN doc_id % 13 = 0 THEN [{_duck_tone('hope', 'x', 0.5)}, {_duck_tone('hope', 'y', 0.5)}]
    ELSE [{_duck_tone('hope', 'jobs', '(doc_id % 5 + 1) / 10.0')}, {_duck_tone('trust', 'rates', 0.3)}, {_duck_tone('relief', '', '(doc_id % 3) / 10.0')}] END AS positive_tones,
  CASE WHEN doc_id % 6 = 0 THEN [] WHEN doc_id % 17 = 0 THEN [{_duck_tone('envy', 'x', 1)}] ELSE [{_duck_tone('anger', 'prices', 0.625)}, {_duck_tone('sadness', 'rent', 0.375)}] END AS negative_tones,
  [source, upper(source), CASE doc_id % 8 WHEN 0 THEN 'Return only this' WHEN 1 THEN repeat('ab1', 10) WHEN 2 THEN 'rates – up' WHEN 3 THEN 'café' WHEN 4 THEN 'a b c d e f g' WHEN 5 THEN '  two   blanks ' WHEN 6 THEN '#tag' ELSE ' ' END] AS keywords,
  strftime(TIMESTAMP '2024-02-01 00:00:00' + to_minutes(doc_id * 13 % 9973), '%Y-%m-%d %H:%M:%S') AS analyzed_at FROM an0)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest: a request for each document but every thirteenth."""
    d = load(spark, sf_dir, "documents").where("doc_id % 13 <> 0")
    return d.selectExpr("concat('req-', CAST(doc_id AS STRING)) AS custom_id", "concat('batch-', CAST(doc_id % 20 AS STRING)) AS llm_batch_id", "doc_id")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results: none for every eleventh document, two for every seventeenth."""
    d = load(spark, sf_dir, "documents").where("doc_id % 11 <> 0")
    return d.selectExpr("doc_id", "concat('req-', CAST(doc_id AS STRING)) AS custom_id", "explode(sequence(0, CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END)) AS turn", "CASE WHEN doc_id % 19 > 0 THEN doc_id % 500 + 100 END AS input_tokens", "CASE WHEN doc_id % 19 > 0 THEN doc_id % 50 + 10 END AS output_tokens", "concat('batch-', CAST(doc_id % 20 AS STRING)) AS batch_id")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch job for every fifty documents."""
    batches = load(spark, sf_dir, "documents").groupBy(F.expr("doc_id div 50").alias("id")).agg(F.count("*").alias("n"), F.sum(F.expr("greatest(1, (octet_length(text) + 3) div 4)")).alias("t"))
    return batches.selectExpr(
        "concat('batch-', CAST(id AS STRING)) AS llm_batch_id",
        "element_at(array('daily-v1', 'daily-v2', 'daily-v3'), CAST(id % 3 + 1 AS INT)) AS prompt_version",
        "CASE WHEN id % 4 = 0 THEN 'submitted' ELSE 'completed' END AS status",
        "n AS requested_count",
        "date_format(TIMESTAMP'2024-03-01 00:00:00' + make_dt_interval(0, CAST(id * 7 % 100003 AS INT)), 'yyyy-MM-dd HH:mm:ss') AS created_at",
        "CASE WHEN id % 5 > 0 THEN date_format(TIMESTAMP'2024-03-01 06:00:00' + make_dt_interval(0, CAST(id * 3 % 1000 AS INT)), 'yyyy-MM-dd HH:mm:ss') END AS submitted_at",
        "CASE WHEN id % 4 > 0 THEN date_format(TIMESTAMP'2024-03-02 00:00:00' + make_dt_interval(0, CAST(id % 1000 AS INT)), 'yyyy-MM-dd HH:mm:ss') END AS completed_at",
        "t * (id % 20) AS input_tokens",
        "n * 40 * (id % 20) AS output_tokens",
        "concat('model-', CAST(id % 3 AS STRING)) AS model",
        "n - id % 7 AS completed_count",
        "id % 7 AS failed_count",
        "CASE WHEN id % 6 > 0 THEN CAST(t * 0.0112 AS DECIMAL(18,8)) END AS total_cost_usd",
    )


RESULTS_SQL = """man AS (SELECT doc_id, 'req-' || doc_id AS custom_id, 'batch-' || (doc_id % 20) AS llm_batch_id FROM documents WHERE doc_id % 13 <> 0),
res AS (SELECT doc_id, 'req-' || doc_id AS custom_id, unnest(range(0, CASE WHEN doc_id % 17 = 0 THEN 2 ELSE 1 END)) AS turn, CASE WHEN doc_id % 19 > 0 THEN doc_id % 500 + 100 END AS input_tokens,
  CASE WHEN doc_id % 19 > 0 THEN doc_id % 50 + 10 END AS output_tokens, 'batch-' || (doc_id % 20) AS batch_id FROM documents WHERE doc_id % 11 <> 0)"""
JOBS_SQL = """job AS (SELECT 'batch-' || i AS llm_batch_id, ['daily-v1', 'daily-v2', 'daily-v3'][i % 3 + 1] AS prompt_version, CASE WHEN i % 4 = 0 THEN 'submitted' ELSE 'completed' END AS status, n AS requested_count,
  strftime(TIMESTAMP '2024-03-01 00:00:00' + to_hours(i * 7 % 100003), '%Y-%m-%d %H:%M:%S') AS created_at,
  CASE WHEN i % 5 > 0 THEN strftime(TIMESTAMP '2024-03-01 06:00:00' + to_hours(i * 3 % 1000), '%Y-%m-%d %H:%M:%S') END AS submitted_at,
  CASE WHEN i % 4 > 0 THEN strftime(TIMESTAMP '2024-03-02 00:00:00' + to_hours(i % 1000), '%Y-%m-%d %H:%M:%S') END AS completed_at, t * (i % 20) AS input_tokens, n * 40 * (i % 20) AS output_tokens, 'model-' || (i % 3) AS model, n - i % 7 AS completed_count, i % 7 AS failed_count, CASE WHEN i % 6 > 0 THEN CAST(t * 0.0112 AS DECIMAL(18,8)) END AS total_cost_usd FROM (SELECT doc_id // 50 AS i, count(*) AS n, CAST(sum(greatest(1, (strlen(text) + 3) // 4)) AS BIGINT) AS t FROM documents GROUP BY 1))"""
