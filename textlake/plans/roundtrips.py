"""Queries that write with the engine's sinks to the shared folder, read back with its sources, and remove what they wrote."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import functions as F

from ..session import delete, shared_folder
from ..sources import copies
from ..sources import events as S
from ..sources import keyed_store, sinks
from . import views

QUERIES, SQL = {}, {}


def query(sql: str, queries: dict = QUERIES, sqls: dict = SQL):
    """Registers a query over (spark, d, folder), which writes below ``folder``; its result is read and kept before that goes."""

    def add(f):
        @functools.wraps(f)
        def run(spark, d):
            folder = f"{shared_folder(spark)}/textlake/trip-{uuid.uuid4().hex}"
            try:
                out = f(spark, d, folder)
                rows = out.toArrow()  # reports and counts, bounded by their group keys
            finally:
                delete(spark, folder)
            return spark.createDataFrame(rows, out.schema)

        queries[f.__name__], sqls[f.__name__] = run, sql
        return f

    return add


EV = "WITH " + views.EVENTS_SQL
MSG = "WITH " + views.MESSAGES_SQL
#: Digest of a set of rows: their number, and the sum of a number made of each one's hash.
HASH = "CAST(sum(CAST('0x' || left(md5({}), 8) AS BIGINT)) AS BIGINT)"


def digest(*parts):
    text = F.concat_ws("|", *parts)
    return [F.count("*").alias("row_count"), F.sum(F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("long")).alias("digest")]


TEXTS = HASH.format("concat_ws('|', event_id, source_type, text)")


def stored(spark, d):
    return views.events(spark, d).select("event_id", "source_type", "source_name", "event_time", "collected_at", "language", "title", "text", "url", "community", F.col("engagement").cast("long").alias("engagement"), "schema_version", F.create_map(F.lit("run"), F.col("run_id")).alias("metadata"))


@query(f"{EV} SELECT source_type, count(*) AS row_count, {TEXTS} AS digest FROM ev GROUP BY source_type")
def q_trip_partitioned(spark, d, folder):
    """Parquet in folders by source, read as a partitioned dataset; every text comes back."""
    sinks.write_partitioned(stored(spark, d), f"{folder}/p", ["source_type"])
    return spark.read.parquet(f"{folder}/p").groupBy("source_type").agg(*digest("event_id", "source_type", "text"))


@query(f"{EV} SELECT count(*) AS row_count, {TEXTS} AS digest FROM ev")
def q_trip_json_glob(spark, d, folder):
    """JSON lines by a glob and an explicit schema."""
    sinks.write_json(stored(spark, d), f"{folder}/j")
    return S.read_json_glob(spark, f"{folder}/j/*.json").agg(*digest("event_id", "source_type", "text"))


@query(f"{MSG} SELECT array_to_string(errors, ',') AS errors, count(*) AS row_count FROM con WHERE trim(value, ' ') <> '' GROUP BY ALL")
def q_trip_jsonl_scan(spark, d, folder):
    """Raw lines, broken ones among them, through the permissive scan and the contract; blank lines are no rows."""
    views.messages(spark, d).where("value IS NOT NULL").select(F.col("value").cast("string")).write.text(f"{folder}/t")
    rows = S.add_contract(S.read_jsonl(spark, f"{folder}/t"))
    return rows.groupBy(F.array_join("contract_errors", ",").alias("errors")).agg(F.count("*").alias("row_count"))


@query(f"{EV} SELECT count(*) AS row_count, {TEXTS} AS digest FROM ev WHERE trim(text, chr(9) || chr(10) || ' ') <> ''")
def q_trip_jsonl_strict(spark, d, folder):
    """Valid events through the validating sink and the strict scan, which fail at the first that isn't valid."""
    good = stored(spark, d).where(r"text RLIKE '[^ \t\n]'")
    sinks.write_json(good, f"{folder}/raw")
    raw = good.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    sinks.write_valid_json(S.read_raw(raw, "value"), f"{folder}/v")
    lines = S.read_json_glob(spark, f"{folder}/v/*.json").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.text(f"{folder}/t")
    return S.read_jsonl_strict(spark, f"{folder}/t").agg(*digest("event_id", "source_type", "text"))


@query(f"{EV} SELECT count(*) AS row_count, {HASH.format('event_id')} AS digest FROM ev WHERE left(event_time, 7) = '2024-01'")
def q_trip_period_scan(spark, d, folder):
    """A month of a dataset by year and month; the other folders are not scanned."""
    e = views.events(spark, d).withColumns({"year": F.left("event_time", F.lit(4)).cast("int"), "month": F.substring("event_time", 6, 2).cast("int")})
    sinks.write_partitioned(e.select("event_id", "year", "month"), f"{folder}/p", ["year", "month"])
    return S.read_period(spark, f"{folder}/p", 2024, 1, ["event_id"]).agg(*digest("event_id"))


@query(f"{EV}, a AS (SELECT left(event_time, 10) AS day, event_id, 1 AS v FROM ev), b AS (SELECT day, event_id, CASE WHEN day IN ('2024-01-01', '2024-01-03') THEN 2 ELSE 1 END AS v FROM a) SELECT v, count(*) AS row_count, {HASH.format('event_id')} AS digest FROM b GROUP BY v")
def q_trip_days_overwrite(spark, d, folder):
    """Two days are written again and replace themselves alone."""
    e = views.events(spark, d).select(F.left("event_time", F.lit(10)).alias("day"), "event_id", F.lit(1).alias("v"))
    sinks.write_days(e, f"{folder}/d", ("day",))
    sinks.write_days(e.where("day IN ('2024-01-01', '2024-01-03')").withColumn("v", F.lit(2)), f"{folder}/d", ("day",))
    return spark.read.parquet(f"{folder}/d").groupBy("v").agg(*digest("event_id"))


@query(f"{EV} SELECT 'jsonl' AS kind, count(*) AS row_count, {HASH.format('event_id')} AS digest FROM ev UNION ALL SELECT 'parquet', count(*), {HASH.format('event_id')} FROM ev UNION ALL SELECT 'route', count(*), {HASH.format('event_id')} FROM ev UNION ALL SELECT 'nothing', 0, 0")
def q_trip_event_scans(spark, d, folder):
    """The dispatch by path, and the scan of a route with folders below it, one of which doesn't exist."""
    sinks.write_json(stored(spark, d), f"{folder}/e.jsonl")
    sinks.write_partitioned(stored(spark, d), f"{folder}/e", ["source_type"])
    reads = {"jsonl": S.read_events(spark, f"{folder}/e.jsonl"), "parquet": S.read_events(spark, f"{folder}/e"), "route": S.read_route(spark, f"{folder}/e", "event_id string"), "nothing": S.read_route(spark, f"{folder}/none", "event_id string")}
    rows = [df.agg(*digest("event_id")).select(F.lit(k).alias("kind"), "row_count", F.coalesce("digest", F.lit(0).cast("long")).alias("digest")) for k, df in reads.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), rows)


@query("SELECT doc_id % 7 AS lang_key, count(*) AS row_count, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY ALL")
def q_trip_csv_report(spark, d, folder):
    """A report as CSV and back."""
    report = views.load(spark, d, "documents").groupBy((F.col("doc_id") % 7).alias("lang_key")).agg(F.count("*").alias("row_count"), F.sum("n_chars").alias("n_chars"))
    sinks.write_csv(report, f"{folder}/c")
    return spark.read.option("header", "true").schema("lang_key long, row_count long, n_chars long").csv(f"{folder}/c")


@query("SELECT '2024-0' || (doc_id % 9 + 1) AS month, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents WHERE doc_id % 9 + 1 BETWEEN 3 AND 7 GROUP BY ALL")
def q_trip_catalog(spark, d, folder):
    """Months of a CSV catalog between two bounds."""
    rows = views.load(spark, d, "documents").select(F.concat(F.lit("2024-0"), F.col("doc_id") % 9 + 1).alias("month"), F.concat(F.lit("f"), F.col("doc_id")).alias("filename"), F.col("n_chars").alias("bytes"))
    sinks.write_csv(rows, f"{folder}/c")
    return S.read_catalog(spark, f"{folder}/c", "2024-03", "2024-07").groupBy("month").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


@query("SELECT user_id % 9 AS run, count(*) AS row_count, CAST(max(event_id) AS BIGINT) AS last FROM events GROUP BY ALL")
def q_trip_run_log(spark, d, folder):
    """A run log as JSON lines."""
    log = views.load(spark, d, "events").select(F.concat(F.lit("run-"), F.col("user_id") % 9).alias("run_id"), F.col("event_id").alias("sequence"), F.col("event_type").alias("event"), F.col("ts").alias("recorded_at"), F.lit(1).alias("row_count"), F.lit(0.5).alias("seconds"))
    sinks.write_json(log, f"{folder}/l")
    back = S.read_run_log(spark, f"{folder}/l")
    return back.groupBy(F.substring("run_id", 5, 9).cast("long").alias("run")).agg(F.count("*").alias("row_count"), F.max("sequence").alias("last"))


@query("SELECT count(*) AS names FROM (SELECT DISTINCT lower(source) FROM documents WHERE source IS NOT NULL)")
def q_trip_allowlist(spark, d, folder):
    """An allowlist with comments, blank lines and every source once."""
    names = views.load(spark, d, "documents").where("source IS NOT NULL").select(F.upper("source").alias("v")).distinct()
    names.select(F.concat(F.lit("\n# group\n "), "v", F.lit(" # known")).alias("value")).write.text(f"{folder}/a")
    return S.allowlist(spark, f"{folder}/a").agg(F.count("*").alias("names"))


@query("SELECT count(DISTINCT n_regionkey) AS files, true AS some_bytes FROM nation")
def q_trip_list_files(spark, d, folder):
    """Files and bytes below a folder, from the listing."""
    views.load(spark, d, "nation").repartition("n_regionkey").write.partitionBy("n_regionkey").parquet(f"{folder}/some")
    return S.list_files(spark, f"{folder}/some").select("files", (F.col("bytes") > 0).alias("some_bytes"))


@query("SELECT CASE WHEN r_regionkey = 0 THEN 'extra' WHEN r_regionkey = 1 THEN 'new' WHEN r_regionkey = 2 THEN 'changed' ELSE 'same' END AS state, count(*) AS files FROM region GROUP BY ALL")
def q_trip_copy_states(spark, d, folder):
    """Two folders of a file a region: one file is only in the target, one only in the source, one differs."""
    line = views.load(spark, d, "region").select("r_regionkey", F.col("r_name").cast("string").alias("value"))
    put = lambda rows, at: rows.repartition(1).write.partitionBy("r_regionkey").text(f"{folder}/{at}")
    put(line.where("r_regionkey <> 0"), "a")
    put(line.where("r_regionkey <> 1").withColumn("value", F.expr("CASE WHEN r_regionkey = 2 THEN lower(value) ELSE value END")), "b")
    named = lambda at: S.file_digests(spark, f"{folder}/{at}").withColumn("name", F.regexp_extract("name", r"r_regionkey=(\d+)/", 1))
    return S.copy_states(named("a"), named("b")).groupBy("state").agg(F.count("*").alias("files"))


@query(f"{EV}, m AS (SELECT event_id, arg_min(coalesce(community, '-'), doc_id) AS community, arg_min(md5(text), doc_id) AS text_md5, arg_max(engagement, doc_id) AS engagement FROM ev GROUP BY event_id) SELECT community, count(*) AS row_count, {HASH.format("concat_ws('|', event_id, community, text_md5, engagement)")} AS digest FROM m GROUP BY community")
def q_store_upsert(spark, d, folder):
    """Three batches upserted into a keyed store, each committed with its ledger entry and delivered twice; then the table."""
    ev = views.events(spark, d).selectExpr("event_id", "doc_id", "coalesce(community, '-') AS community", "md5(text) AS text_md5", "engagement")
    store = keyed_store.KeyedStore(spark, folder, ["event_id"], 16)
    for k, batch in enumerate(("doc_id % 50 NOT IN (0, 7)", "doc_id % 50 = 7", "doc_id % 50 = 0")):
        for _ in range(2):
            store.upsert(ev.where(batch), [F.col("doc_id")], ["community", "text_md5"], ["engagement"], "loader", k)
    return store.read().groupBy("community").agg(*digest("event_id", "community", "text_md5", F.col("engagement").cast("string")))


@query(f"SELECT source, count(*) AS row_count, {HASH.format("concat_ws('|', doc_id, text)")} AS digest, 'same' AS states FROM documents GROUP BY source")
def q_trip_verified_copy(spark, d, folder):
    """All documents in files by source, copied with verification, copied again, and read from the copy."""
    views.load(spark, d, "documents").select("doc_id", "text", "source").write.partitionBy("source").parquet(f"{folder}/a")
    statuses = [[r.status for r in copies.copy_verified(spark, f"{folder}/a", f"{folder}/b").collect()] for _ in range(2)]  # a row a file
    if set(statuses[0]) != {"copied"} or set(statuses[1]) != {"same"}:
        raise ValueError(f"copied, then the same: {statuses}")
    states = S.verified(S.copy_states(S.file_digests(spark, f"{folder}/a"), S.file_digests(spark, f"{folder}/b"))).agg(F.max("state").alias("states"))
    return spark.read.parquet(f"{folder}/b").groupBy("source").agg(*digest(F.col("doc_id").cast("string"), "text")).join(F.broadcast(states), F.lit(True))
