"""Queries of ingestion: contract, quality, routes, accounting, dedup and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import contract, kernels, quality
from ..operators import accounting, dedup, reconcile, routing
from . import views

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def raw(spark, d):
    return routing.parse_messages(views.messages(spark, d))


def routed(spark, d):
    return routing.add_route(routing.transform(raw(spark, d)))


MSG, ROUTED, EV = "WITH " + views.MESSAGES_SQL, "WITH " + views.routed_sql(), "WITH " + views.EVENTS_SQL
EVQ = f"{EV}, {views.quality_sql('ev')}"


@query(f"{ROUTED} SELECT output_route, CASE WHEN len(errors) > 0 THEN 'none' WHEN reason IN ('SOURCE_TOMBSTONE', 'EMPTY_AFTER_NORMALIZATION') THEN 'reject' WHEN reason IS NOT NULL THEN 'quarantine' ELSE 'accept_or_flag' END AS quality, count(*) AS row_count FROM routed GROUP BY ALL")
def q_route_counts(spark, d):
    status = F.when(~F.col("contract_valid"), "none").when(F.col("quality_status").isin("accept", "flag"), "accept_or_flag").otherwise(F.col("quality_status"))
    return accounting.label_counts(routed(spark, d).withColumn("quality", status), "output_route", "quality")


@query(f"{MSG} SELECT error, count(*) AS row_count FROM (SELECT unnest(errors) AS error FROM con) GROUP BY error")
def q_contract_errors(spark, d):
    return accounting.frequency(contract.add_contract(raw(spark, d)), "contract_errors", "error")


@query(f"{MSG} SELECT part AS kafka_partition, off AS kafka_offset, array_to_string(errors, ',') AS errors, len(errors) = 0 AS contract_valid FROM con")
def q_contract_rows(spark, d):
    rows = contract.add_contract(raw(spark, d))
    return rows.select("kafka_partition", "kafka_offset", F.array_join("contract_errors", ",").alias("errors"), "contract_valid")


@query(f"{EVQ} SELECT doc_id, CAST(chars AS BIGINT) AS character_count, CAST(bytes AS BIGINT) AS utf8_byte_count, CAST(controls AS BIGINT) AS control_character_count, CAST(zero_width AS BIGINT) AS zero_width_count, CAST(marks AS INT) AS max_combining_mark_run, CAST(url_count AS INT) AS url_count, CAST(url_ratio AS DOUBLE) AS url_ratio, clean <> text AS was_normalized FROM q")
def q_quality_metrics(spark, d):
    cols = ["character_count", "utf8_byte_count", "control_character_count", "zero_width_count", "max_combining_mark_run", "url_count", "url_ratio", "was_normalized"]
    return quality.add_quality(views.events(spark, d)).select("doc_id", *cols)


@query(f"{EVQ} SELECT doc_id, array_to_string(flags, ',') AS flags, reason AS exclusion_reason FROM q")
def q_quality_flags(spark, d):
    """HIGH_REPETITION is left out, as it depends on zlib's output."""
    df = quality.add_quality(views.events(spark, d))
    return df.select("doc_id", F.array_join(F.array_remove("quality_flags", "HIGH_REPETITION"), ",").alias("flags"), "exclusion_reason")


@query(f"WITH {views.quality_sql('documents')} SELECT doc_id, pii FROM q")
def q_pii_flags(spark, d):
    return views.load(spark, d, "documents").select("doc_id", quality.personal(F.col("text")).alias("pii"))


@query(f"WITH {views.quality_sql('documents')}, n AS (SELECT doc_id, len(t) AS n, list_max(map_values(list_histogram(t))) AS m FROM (SELECT doc_id, string_split(compact, '') AS t FROM q)) SELECT doc_id, round(m / n, 4) AS dominant FROM n WHERE n >= 100")
def q_repetition_dominant(spark, d):
    compact = F.regexp_replace(quality.strip(F.col("text")), quality.WHITE, "")
    df = views.load(spark, d, "documents").where(F.length(compact) >= 100)
    return df.select("doc_id", F.round(kernels.repetition(compact)["dominant"], 4).alias("dominant"))


@query()
def q_repetition_zlib(spark, d):
    df = quality.add_quality(views.events(spark, d))
    return df.where(F.array_contains("quality_flags", "HIGH_REPETITION")).select("doc_id", "repetition_ratio")


@query(f"{EVQ} SELECT doc_id, clean AS text_clean FROM q")
def q_nfc_clean(spark, d):
    return quality.add_quality(views.events(spark, d)).select("doc_id", "text_clean")


@query(f"{EVQ} SELECT CASE WHEN reason IN ('SOURCE_TOMBSTONE', 'EMPTY_AFTER_NORMALIZATION') THEN 'reject' WHEN reason IS NOT NULL THEN 'quarantine' ELSE 'accept_or_flag' END AS quality, source_type, count(*) AS row_count FROM q GROUP BY ALL")
def q_quality_status_counts(spark, d):
    df = quality.add_quality(views.events(spark, d))
    status = F.when(F.col("quality_status").isin("accept", "flag"), "accept_or_flag").otherwise(F.col("quality_status"))
    return accounting.label_counts(df.withColumn("quality", status), "quality", "source_type")


@query(f"{EVQ} SELECT flag, count(*) AS row_count FROM (SELECT unnest(flags) AS flag FROM q) GROUP BY flag")
def q_flag_counts(spark, d):
    return accounting.frequency(quality.add_quality(views.events(spark, d)), "quality_flags", "flag").where("flag <> 'HIGH_REPETITION'")


@query("SELECT CAST(min(length(text)) AS INT) AS min_chars, CAST(max(length(text)) AS INT) AS max_chars, round(avg(length(text)), 2) AS avg_chars, CAST(max(strlen(text)) AS INT) AS max_bytes FROM documents")
def q_length_summary(spark, d):
    return accounting.length_summary(views.load(spark, d, "documents"))


@query(f"""{MSG}, k AS (SELECT len(errors) = 0 AS ok, CASE WHEN len(errors) = 0 THEN event_id END AS e, count(*) AS n, sum(coalesce(strlen(value), 0)) AS b FROM con GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS input_rows, CAST(sum(n) FILTER (NOT ok) AS BIGINT) AS rejected_rows, CAST(sum(n) FILTER (ok) AS BIGINT) AS valid_rows, count(*) FILTER (ok) AS unique_rows,
  CAST(sum(n - 1) FILTER (ok) AS BIGINT) AS duplicate_rows, CAST(sum(b) AS BIGINT) AS raw_bytes FROM k""")
def q_row_accounting(spark, d):
    return accounting.checked(accounting.account(contract.add_contract(raw(spark, d))))


def order():
    return [F.col("collected_at"), F.col("doc_id")]


@query(f"{EV} SELECT event_id, doc_id, engagement, language FROM ev QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY collected_at, doc_id) = 1")
def q_dedup_first(spark, d):
    return dedup.first_wins(views.events(spark, d), ["event_id"], order()).select("event_id", "doc_id", "engagement", "language")


@query(f"{EV} SELECT event_id, doc_id, engagement, language FROM ev QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY collected_at DESC, doc_id DESC) = 1")
def q_dedup_latest(spark, d):
    return dedup.latest_wins(views.events(spark, d), ["event_id"], order()).select("event_id", "doc_id", "engagement", "language")


@query(f"{EV} SELECT event_id, doc_id FROM ev QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY collected_at, doc_id) > 1")
def q_dedup_dropped(spark, d):
    return dedup.duplicates(views.events(spark, d), ["event_id"], order()).select("event_id", "doc_id")


@query(f"{EV} SELECT event_id, arg_min(coalesce(community, '-'), doc_id) AS community, arg_min(md5(text), doc_id) AS text_md5, arg_max(collected_at, doc_id) AS collected_at, arg_max(engagement, doc_id) AS engagement FROM ev GROUP BY event_id")
def q_upsert_selective(spark, d):
    ev = views.events(spark, d).withColumns({"community": F.coalesce("community", F.lit("-")), "text_md5": F.md5("text")})
    stored, incoming = ev.where("doc_id % 50 <> 0"), ev.where("doc_id % 50 = 0")
    return dedup.upsert(stored, incoming, ["event_id"], [F.col("doc_id")], ["community", "text_md5"], ["collected_at", "engagement"])


@query(f"{MSG} SELECT topic, part AS kafka_partition, off AS kafka_offset, array_to_string(errors, ',') AS errors, 1 AS batch_id FROM con WHERE len(errors) > 0")
def q_rejected_upsert(spark, d):
    """Rejected messages delivered twice: the second batch's errors and number stay."""
    rows = contract.add_contract(raw(spark, d)).where("NOT contract_valid").select(F.col("kafka_topic").alias("topic"), "kafka_partition", "kafka_offset", F.array_join("contract_errors", ",").alias("errors"))
    twice = rows.withColumn("batch_id", F.explode(F.array(F.lit(0), F.lit(1))))
    return dedup.merge(twice, ["topic", "kafka_partition", "kafka_offset"], [F.col("batch_id")], [], ["errors", "batch_id"])


@query(f"{MSG}, b AS (SELECT *, off % 5 AS batch_id FROM msg) SELECT part AS kafka_partition, count(*) AS row_count FROM b WHERE batch_id NOT IN (1, 3) GROUP BY part")
def q_commit_ledger(spark, d):
    ledger = spark.createDataFrame([("loader", 1), ("loader", 3), ("other", 2)], "consumer_name string, batch_id long")
    batches = views.messages(spark, d).select(F.lit("loader").alias("consumer_name"), (F.col("offset") % 5).alias("batch_id"), "partition")
    return accounting.label_counts(dedup.uncommitted(batches, ledger).withColumnRenamed("partition", "kafka_partition"), "kafka_partition")


@query(f"{EV} SELECT count(DISTINCT event_id) AS distinct_ids, count(*) AS row_count FROM ev")
def q_distinct_ids(spark, d):
    return views.events(spark, d).agg(F.count_distinct("event_id").alias("distinct_ids"), F.count("*").alias("row_count"))


@query(f"{MSG} SELECT doc_id, array_to_string(list_sort(list_filter(want, lambda x: NOT list_contains(keys, x))), ',') AS missing, array_to_string(list_filter(keys, lambda x: NOT list_contains(want, x)), ',') AS unexpected, len(list_intersect(keys, ['text', 'title'])) AS text_fields FROM fields")
def q_except_intersect_fields(spark, d):
    from ..schemas import EVENT_FIELDS

    keys = F.coalesce("_json_keys", F.array().cast("array<string>"))
    want = F.array(*map(F.lit, EVENT_FIELDS))
    return raw(spark, d).select(
        F.col("kafka_key").cast("long").alias("doc_id"),
        F.array_join(F.array_sort(F.array_except(want, keys)), ",").alias("missing"),
        F.array_join(F.array_except(keys, want), ",").alias("unexpected"),
        F.size(F.array_intersect(keys, F.array(F.lit("text"), F.lit("title")))).cast("long").alias("text_fields"),
    )


@query(f"{MSG} SELECT topic || ':' || part || ':' || off AS key, array_to_string(errors, ',') AS errors, value AS raw_event FROM con WHERE len(errors) > 0")
def q_dlq_payload(spark, d):
    letters = routing.dead_letters(contract.add_contract(raw(spark, d)).where("NOT contract_valid"))
    value = F.from_json("value", "reason string, contract_errors array<string>, raw_event string, source_topic string, source_partition int, source_offset long, rejected_at string")
    return letters.select("key", value.alias("v")).where("v.rejected_at IS NOT NULL AND v.reason = 'CONTRACT_REJECTED'").select("key", F.array_join("v.contract_errors", ",").alias("errors"), "v.raw_event")


RANGES = [("events", 0, 10, 200), ("events", 1, 0, 50), ("events", 2, 300, 300)]


@query(f"{MSG} SELECT part AS kafka_partition, off AS kafka_offset FROM msg WHERE part = 0 AND off >= 10 AND off < 200 OR part = 1 AND off < 50")
def q_bounded_range(spark, d):
    ranges = spark.createDataFrame(RANGES, "topic string, partition int, start_offset long, end_offset long")
    return routing.bounded(views.messages(spark, d), ranges).select(F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"))


@query(f"{MSG}, o AS (SELECT topic, part, min(off) AS a, max(off) + 1 AS z FROM msg GROUP BY topic, part) SELECT topic, CAST(sum(z - a) AS BIGINT) AS span FROM o GROUP BY topic")
def q_offset_span(spark, d):
    """From the first to behind the last offset of each captured partition."""
    at = views.messages(spark, d).groupBy("topic", "partition").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("behind"))
    return reconcile.offset_span(at.select("topic", "partition", F.col("first").alias("offset")), at.select("topic", "partition", F.col("behind").alias("offset")))


@query(f"{EV} SELECT count(*) AS input_rows, count(DISTINCT event_id) AS stored_rows, count(*) - count(DISTINCT event_id) AS duplicate_rows, count(*) FILTER (source_name = 'web_news') AS web_news_rows, count(*) FILTER (source_name = 'reddit') AS reddit_rows FROM ev")
def q_finalization(spark, d):
    return accounting.finalization(views.events(spark, d), ("web_news", "reddit"))


@query(f"{MSG} SELECT part AS kafka_partition, max(off) + 1 AS high_watermark FROM msg GROUP BY part")
def q_high_watermarks(spark, d):
    return views.messages(spark, d).groupBy(F.col("partition").alias("kafka_partition")).agg((F.max("offset") + 1).alias("high_watermark"))


@query(f"{MSG} SELECT run_id = 'run-1' AND analysis_date = '2024-01-02' AS of_run, count(*) AS row_count FROM (SELECT coalesce(run_id, '') AS run_id, coalesce(analysis_date, '') AS analysis_date FROM fields) GROUP BY ALL")
def q_foreign_rows(spark, d):
    rows = raw(spark, d)
    mine = routing.of_run(rows, "run-1", "2024-01-02").select(F.lit(True).alias("of_run"))
    counts = mine.groupBy("of_run").agg(F.count("*").alias("row_count"))
    return counts.unionByName(rows.agg(F.count("*").alias("n")).join(counts.select("row_count"), F.lit(True), "left").select(F.lit(False).alias("of_run"), (F.col("n") - F.coalesce("row_count", F.lit(0))).alias("row_count")))
