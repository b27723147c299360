"""Queries over streams: a captured topic is written as files and consumed with availableNow."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import functions as F

from ..session import delete, shared_folder
from ..sources import message_log
from ..streaming import consumer
from . import views
from .roundtrips import HASH, query

QUERIES, SQL = {}, {}
add = functools.partial(query, queries=QUERIES, sqls=SQL)


def consumed(spark, d) -> str:
    """Folder in which a consumer has read the view of messages as one batch; its output is below out."""
    root = f"{shared_folder(spark)}/textlake/stream-{uuid.uuid4().hex}"
    views.messages(spark, d).write.parquet(f"{root}/topic")
    c = consumer.ConsumerConfig("events", "dead", f"{root}/out", f"{root}/checkpoint", watermark="3650 days")
    query = consumer.start(consumer.file_messages(spark, f"{root}/topic"), c)
    query.awaitTermination()
    return root


def q_stream_routes(spark, d):
    """Rows that the consumer wrote, rejected by the contract or not, after dedup.

    Repeated ids have other texts here and any of them may stay, so the three routes of valid rows are summed.
    """
    root = consumed(spark, d)
    rows = consumer.read_ledger(spark, f"{root}/out").collect()  # one batch
    delete(spark, root)
    ledger = spark.createDataFrame(rows, consumer.LEDGER)
    counts = F.explode(F.from_json("route_counts", "map<string,long>")).alias("output_route", "n")
    return ledger.select(counts).groupBy((F.col("output_route") != "contract_rejected").alias("contract_valid")).agg(F.sum("n").alias("row_count"))


QUERIES["q_stream_routes"] = q_stream_routes
SQL["q_stream_routes"] = f"""WITH {views.MESSAGES_SQL}, k AS (SELECT DISTINCT len(errors) = 0 AS contract_valid, CASE WHEN len(errors) = 0 THEN event_id ELSE topic || ':' || part || ':' || off END AS key FROM con)
SELECT contract_valid, count(*) AS row_count FROM k GROUP BY contract_valid"""


#: Three deliveries by doc_id, each a batch of the consumer, and how long it waits for late rows.
DELIVERY, WAIT = "CASE WHEN doc_id % 10 < 7 THEN 0 WHEN doc_id % 10 < 9 THEN 1 ELSE 2 END", "2 days"


def deliver(spark, d, root: str, number: int) -> None:
    """Publishes one of the deliveries to the log below ``root``, twice under one name, which counts once."""
    rows = views.messages(spark, d).withColumn("doc_id", F.col("key").cast("string").cast("long")).where(F.expr(DELIVERY) == number)
    out = message_log.rows_to_publish(rows, 3, F.col("key"), F.col("value"), F.col("timestamp"))
    for _ in range(2):
        message_log.publish(out, root, "events", "deliveries", number)


@add(f"""WITH {views.MESSAGES_SQL} SELECT CAST(doc_id % 10 AS BIGINT) AS last_digit, count(*) AS row_count, {HASH.format("coalesce(value, 'null')")} AS digest, true AS places_differ FROM msg GROUP BY 1""")
def q_log_replay(spark, d, folder):
    """Messages published to a log in three commits, read back as one exact range of offsets."""
    for k in range(3):
        deliver(spark, d, folder, k)
    rows = message_log.read_range(spark, folder, "events", "earliest", "latest")
    value = F.coalesce(F.col("value").cast("string"), F.lit("null"))
    number = F.conv(F.left(F.md5(value), F.lit(8)), 16, 10).cast("long")
    digit = (F.col("key").cast("string").cast("long") % 10).alias("last_digit")
    return rows.groupBy(digit).agg(F.count("*").alias("row_count"), F.sum(number).alias("digest"), (F.count_distinct("partition", "offset") == F.count("*")).alias("places_differ"))


@add(f"""WITH {views.routed_sql()},
s AS (SELECT *, {DELIVERY} AS batch, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id * 7) AS seen FROM routed),
w AS (SELECT batch, max(max(seen)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {WAIT} AS mark FROM s GROUP BY batch),
l AS (SELECT s.*, mark, output_route <> 'contract_rejected' AND coalesce(seen < mark, false) AS late FROM s JOIN w USING (batch)),
k AS (SELECT *, output_route <> 'contract_rejected' AND NOT late AND EXISTS (FROM l b WHERE b.event_id = l.event_id AND NOT b.late AND b.output_route <> 'contract_rejected' AND b.doc_id <> l.doc_id
        AND (b.batch, b.off, b.part) < (l.batch, l.off, l.part) AND coalesce(b.seen + INTERVAL {WAIT} > l.mark, true)) AS again FROM l)
SELECT CASE WHEN late THEN 'late' WHEN again THEN 'duplicate' ELSE output_route END AS output_route, count(*) AS row_count FROM k GROUP BY 1""")
def q_stream_accounted(spark, d, folder):
    """Every message on one route, late and repeated ones too: three deliveries, a run of the consumer after each."""
    c = consumer.ConsumerConfig("events", "dead", f"{folder}/out", f"{folder}/check", watermark=WAIT, account_all=True)
    for k in range(3):
        deliver(spark, d, f"{folder}/log", k)
        consumer.start(consumer.log_messages(spark, f"{folder}/log", c), c).awaitTermination()
    counts = F.explode(F.from_json("route_counts", "map<string,long>")).alias("output_route", "n")
    return consumer.read_ledger(spark, f"{folder}/out").select(counts).groupBy("output_route").agg(F.sum("n").alias("row_count"))
