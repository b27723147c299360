"""Queries of feeds: article searches, listings, RSS, windows, the generator and the strict contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.contract import add_contract
from ..operators import groups, intervals, sampling
from ..sources import events as S
from . import views

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


NOW = "2024-06-01T00:00:00Z"


@query(
    "SELECT sha256('gdelt:' || url) AS event_id, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id), '%Y-%m-%dT%H:%M:%SZ') AS event_time, CASE WHEN page_id % 3 = 0 THEN 'unknown' ELSE 'english' END AS language, 'Page ' || page_id AS text, url, 'rates' AS query, "
    "CASE WHEN page_id % 2 = 0 THEN 'example.com' END AS domain FROM pages WHERE page_id % 7 NOT IN (1, 2, 3) AND trim(url) <> ''"
)
def q_article_events(spark, d):
    """Article objects, some without URL, title or a time that can be read."""
    made = views.load(spark, d, "pages").selectExpr(
        "CASE WHEN page_id % 7 = 1 THEN ' ' ELSE concat(' ', url) END AS url",
        "CASE WHEN page_id % 7 = 2 THEN NULL ELSE concat('Page ', page_id) END AS title",
        "CASE WHEN page_id % 7 = 3 THEN 'today' ELSE date_format(timestamp_seconds(1704067200 + page_id * 60), \"yyyyMMdd'T'HHmmss'Z'\") END AS seendate",
        "CASE WHEN page_id % 3 > 0 THEN 'English' END AS language",
        "CASE WHEN page_id % 2 = 0 THEN 'example.com' END AS domain",
    )
    out = S.article_events(made.select(F.to_json(F.struct("*")).alias("raw")), "rates", NOW)
    return out.select("event_id", "event_time", "language", "text", "url", F.col("metadata")["query"].alias("query"), F.col("metadata")["domain"].alias("domain"))


KEPT = "text IS NOT NULL AND trim(text, ' ') <> '' AND text NOT IN ('[deleted]', '[removed]') AND conv_id * 60 + turn BETWEEN 600 AND 59999"


@query(f"SELECT sha256('reddit:' || conv_id || '-' || turn) AS event_id, strftime(to_timestamp(1704067200 + conv_id * 60 + turn) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS event_time, length(trim(text, ' ')) AS chars, role AS community, CAST(turn AS BIGINT) AS engagement, CASE WHEN turn % 2 = 0 THEN 'https://www.reddit.com/r/' || conv_id END AS url FROM conversations WHERE {KEPT}")
def q_listing_events(spark, d):
    """Pages of a listing, a conversation each and twice, within a half-open window."""
    child = F.struct(F.struct(F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("text").alias("body"), F.col("role").alias("subreddit"), F.expr("CAST(1704067200 + conv_id * 60 + turn AS DOUBLE)").alias("created_utc"), F.col("turn").alias("score"), F.when(F.col("turn") % 2 == 0, F.concat(F.lit("/r/"), "conv_id")).alias("permalink")).alias("data"))
    pages = views.load(spark, d, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.struct(F.collect_list(child).alias("children")).alias("data"))).alias("raw"))
    twice = pages.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1))))
    at = lambda s: F.timestamp_seconds(F.lit(1704067200 + s))
    return S.listing_events(twice, at(600), at(60_000), NOW).select("event_id", "event_time", F.length("text").cast("long").alias("chars"), "community", "engagement", "url")


@query("SELECT page_id, 'Page ' || page_id AS title, 'Paper ' || (page_id % 5) AS publisher, strftime(TIMESTAMP '2024-01-02 09:00:00' + to_minutes(page_id), '%Y-%m-%d %H:%M:%S') AS published FROM pages WHERE page_id % 6 <> 0 UNION ALL SELECT page_id, 'Other', 'Unknown', '2024-01-02 09:00:00' FROM pages WHERE page_id % 6 <> 0")
def q_rss_items(spark, d):
    """Feeds of two items, publishers behind the titles, one in six without a link."""
    time = F.date_format(F.timestamp_seconds(F.expr("1704186000 + page_id * 60")), "EEE, d MMM yyyy HH:mm:ss 'GMT'")
    link = F.expr("CASE WHEN page_id % 6 = 0 THEN '' ELSE concat('<link>http://a/', page_id, '</link>') END")
    paper = F.concat(F.lit("Paper "), F.col("page_id") % 5)
    xml = F.concat(F.lit("<rss><channel><item><title>Page "), "page_id", F.lit(" - "), paper, F.lit("</title>"), link, F.lit("<pubDate>"), time, F.lit("</pubDate><source>"), paper, F.lit("</source></item><item><title>Other</title>"), link, F.lit("<pubDate>2 Jan 2024 09:00:00 +0000</pubDate></item></channel></rss>"))
    items = S.rss_items(views.load(spark, d, "pages").select("page_id", xml.alias("xml")))
    return items.select("page_id", "title", "publisher", F.date_format("published", "yyyy-MM-dd HH:mm:ss").alias("published"))


@query("SELECT user_id % 5 AS k, count(*) AS row_count, count(*) FILTER (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09') AS inside_rows FROM events GROUP BY ALL")
def q_half_open_window(spark, d):
    at = lambda x: F.lit(x).cast("timestamp")
    return views.load(spark, d, "events").groupBy((F.col("user_id") % 5).alias("k")).agg(F.count("*").alias("row_count"), F.count_if(intervals.inside(F.col("ts").cast("timestamp"), at("2024-01-05"), at("2024-01-09"))).alias("inside_rows"))


@query("WITH g AS (SELECT i, i - CASE WHEN i > 0 AND i % 50 = 0 THEN 1 ELSE 0 END AS j FROM (SELECT doc_id AS i FROM documents)) SELECT sha256(CASE WHEN j % 2 = 0 THEN 'gdelt' ELSE 'reddit' END || ':synthetic-' || j) AS event_id, CASE WHEN j % 2 = 0 THEN 'news' ELSE 'comment' END AS source_type, strftime(TIMESTAMP '2026-01-01 00:00:00' + to_seconds(j), '%Y-%m-%dT%H:%M:%SZ') AS event_time, CASE WHEN j % 2 = 1 THEN j % 41 - 10 ELSE -99 END AS engagement, count(*) AS row_count FROM g GROUP BY ALL")
def q_generator(spark, d):
    """Synthetic events, one for each document; every fiftieth repeats the one before."""
    return S.synthetic(views.load(spark, d, "documents").select(F.col("doc_id").alias("id"))).groupBy("event_id", "source_type", "event_time", F.coalesce("engagement", F.lit(-99).cast("long")).alias("engagement")).agg(F.count("*").alias("row_count"))


STRICT = "regexp_matches({}, '(?i)[T ][0-9][0-9](:?[0-9][0-9]){{0,2}}([.,][0-9]+)?(Z|[+-][0-9][0-9](:?[0-9][0-9]){{0,2}})$')"


@query(
    f"WITH {views.EVENTS_SQL}, s AS (SELECT *, CASE doc_id % 5 WHEN 1 THEN left(event_time, 19) WHEN 2 THEN left(event_time, 19) || '+09:00' WHEN 3 THEN left(event_time, 10) ELSE event_time END AS t, CASE doc_id % 7 WHEN 1 THEN chr(9) WHEN 2 THEN chr(160) ELSE language END AS l FROM ev) "
    rf"SELECT doc_id, NOT coalesce({STRICT.format('t')}, false) AS bad_time, coalesce(regexp_full_match(l, '[\s\x{{a0}}]*'), true) AS bad_language FROM s"
)
def q_strict_contract(spark, d):
    """Zones on times, and languages that are more than Unicode blanks."""
    e = views.events(spark, d).withColumns({"event_time": F.expr("CASE doc_id % 5 WHEN 1 THEN left(event_time, 19) WHEN 2 THEN concat(left(event_time, 19), '+09:00') WHEN 3 THEN left(event_time, 10) ELSE event_time END"), "language": F.expr(r"CASE doc_id % 7 WHEN 1 THEN '\t' WHEN 2 THEN ' ' ELSE language END")})
    e = e.withColumns({"metadata": F.create_map(F.lit("a"), F.lit("b")), "_corrupt_record": F.lit(None).cast("string"), "_json_keys": F.lit(None).cast("array<string>")})
    out = add_contract(e, strict=True)
    return out.select("doc_id", F.array_contains("contract_errors", "INVALID_EVENT_TIME").alias("bad_time"), F.array_contains("contract_errors", "MISSING_LANGUAGE").alias("bad_language"))


@query(f"WITH {views.EVENTS_SQL} SELECT event_id, min(doc_id) AS doc_id FROM ev WHERE trim(text, ' ') <> '' AND lower(trim(text, ' ')) NOT IN ('[deleted]', '[removed]') GROUP BY event_id")
def q_eligible_without_limit(spark, d):
    """Limit 0 takes all first eligible rows."""
    return sampling.first_eligible(views.events(spark, d), groups.eligible(F.col("text")), ["event_id"], [F.col("doc_id")], 0).select("event_id", "doc_id")
