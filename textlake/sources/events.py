"""Sources: event files, archives, period datasets, feeds, pages, catalogs, artifacts and a generator.

Network fetches are not part of the engine; what they return (XML, HTML, listings) is read here.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import cards, kernels
from ..functions.contract import add_contract, read_raw, require_valid
from ..functions.text import canonical_url
from ..schemas import ARCHIVE_COLUMNS, EVENT, EVENT_FIELDS
from . import copies

#: Artifact folders and the bucket and prefix that each goes to (fixed values).
ARTIFACTS = {
    "raw": ("news-raw", "raw"),
    "finalized": ("news-processed", "finalized"),
    "airflow-input": ("news-raw", "airflow-input"),
    "selected": ("news-processed", "selected"),
    "experiments": ("news-processed", "experiments"),
    "airflow-output": ("news-processed", "airflow-output"),
    "airflow-output-minio": ("news-processed", "airflow-output-minio"),
    "validation": ("news-processed", "validation"),
    "llm": ("news-llm", "requests"),
    "llm_response": ("news-llm", "responses"),
    "reports": ("news-reports", "reports"),
    "logs": ("news-reports", "logs"),
    "minio-validation": ("news-reports", "minio-validation"),
    "ingestion-guide": ("news-reports", "ingestion-guide"),
    "system-diagrams": ("news-reports", "system-diagrams"),
}
EXCLUDED = (r"\.part$", r"\.tmp$", r"\.prefix$", r"\.footer$", r"\.sparse\.parquet$", r"\.crc$", r"(^|/)minio-data-migration[^/]*\.jsonl?$")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Raw events of JSON lines; broken lines stay, as rows with errors. Blank lines are passed over."""
    return read_raw(spark.read.text(path).where(F.trim("value") != ""), "value")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files, lines from 1 in each file.

    Files are read in splits; a first pass counts each split's lines, and only these counts, a row a
    split, come to the driver.
    """
    split = ["file", "start"]
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("_at"), "value")
    found = lines.groupBy(*split).agg(F.min("_at").alias("_first"), F.count("*").alias("n")).collect()
    before: dict[str, int] = {}
    rows = []
    for r in sorted(found, key=lambda r: (r.file, r.start)):
        rows.append((r.file, r.start, r._first - before.get(r.file, 0) - 1))
        before[r.file] = before.get(r.file, 0) + r.n
    shift = spark.createDataFrame(rows, "file string, start long, _shift long")
    return lines.join(F.broadcast(shift), split).select("file", (F.col("_at") - F.col("_shift")).alias("line"), "value")


def read_jsonl_strict(spark: SparkSession, path: str) -> DataFrame:
    """Events of JSON lines; the query fails at one that breaks the strict contract, and tells its file and line."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    events = add_contract(read_raw(lines, "value"), strict=True)
    return require_valid(events, F.concat_ws(":", "file", "line")).select(*EVENT_FIELDS)


def read_json_glob(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).json(path)


def require_columns(df: DataFrame, columns: Sequence[str] = ARCHIVE_COLUMNS) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_period(spark: SparkSession, root: str, year: int, month: int, columns: Sequence[str]) -> DataFrame:
    """A month of a dataset with year= and month= folders; other months' files are not listed into the scan."""
    return spark.read.parquet(root).where((F.col("year") == year) & (F.col("month") == month)).select(*columns)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Parquet for folders and .parquet paths, JSON lines for others; event_id, source_name and a text are required."""
    if path.endswith((".jsonl", ".json")):
        return read_json_glob(spark, path)
    df = require_columns(spark.read.parquet(path), ("event_id", "source_name"))
    if not {"text", "title"} & set(df.columns):
        raise ValueError("missing columns: text or title")
    return df.select(*[c for c in ("event_id", "source_name", "source_type", "title", "text") if c in df.columns])


def read_route(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All Parquet files below ``path``; no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """One row: files below ``path`` and their bytes, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(name, length, sha256) of the files below ``path``.

    Files are read in parts; only in stores that Python workers can't open is a file held in memory
    while its digest is made, through Spark's own file systems.
    """
    if copies.reachable(path):
        return copies.file_digests(spark, path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    base = path.rstrip("/").split(":", 1)[-1].lstrip("/")
    return files.select(F.regexp_replace("path", rf"^.*?\Q{base}/\E", "").alias("name"), "length", F.sha2("content", 256).alias("sha256"))


def copy_states(source: DataFrame, target: DataFrame) -> DataFrame:
    """(name, length, state) of the files of two digest tables: new, changed, same, or extra in the target; the first two are to be copied."""
    s, t = source.withColumn("_s", F.lit(True)), target.select("name", F.col("length").alias("_l"), F.col("sha256").alias("_h"))
    both = s.join(t, "name", "full")
    same = (F.col("length") == F.col("_l")) & (F.col("sha256") == F.col("_h"))
    state = F.when(F.col("_s").isNull(), "extra").when(F.col("_h").isNull(), "new").when(same, "same").otherwise("changed")
    return both.select("name", F.coalesce("length", "_l").alias("length"), state.alias("state"))


def verified(states: DataFrame) -> DataFrame:
    """``states`` after a copy; reading it fails at the first file that isn't the same on both sides. Extra files are let be."""
    return states.where(F.assert_true(F.col("state").isin("same", "extra"), F.concat(F.col("state"), F.lit(" after the copy: "), F.col("name"))).isNull())


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("run_id string, sequence long, event string, recorded_at timestamp, row_count long, seconds double").json(path)


def read_catalog(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of a CSV catalog with months between ``first`` and ``last`` (yyyy-MM, both included)."""
    df = spark.read.option("header", "true").schema("month string, filename string, bytes long").csv(path)
    return df.where((F.lit(first).isNull() | (F.col("month") >= first)) & (F.lit(last).isNull() | (F.col("month") <= last)))


def month_sizes(files: DataFrame) -> DataFrame:
    """month, gib and mean daily MiB of files named RC_yyyy-MM.parquet (name, bytes)."""
    month = F.regexp_extract("name", r"RC_(\d{4}-\d\d)\.parquet$", 1)
    days = F.dayofmonth(F.last_day(F.try_to_timestamp("month", F.lit("yyyy-MM"))))
    df = files.withColumn("month", month).where("month <> ''")
    return df.select("month", "bytes", F.round(F.col("bytes") / 2**30, 4).alias("gib"), F.round(F.col("bytes") / days / 2**20, 4).alias("average_daily_mib"))


def allowlist(spark: SparkSession, path: str) -> DataFrame:
    """Names of a text file, comments and blank lines left out; the query fails if one occurs twice, case aside."""
    lines = spark.read.text(path).select(F.trim(F.split_part("value", F.lit("#"), F.lit(1))).alias("name")).where("name <> ''")
    named = lines.groupBy(F.lower("name").alias("key")).agg(F.min("name").alias("name"), F.count("*").alias("n"))
    return named.where(F.assert_true(F.col("n") == 1, F.concat(F.lit("repeated name: "), F.col("name"))).isNull()).select("name")


def archive_rows(archive: DataFrame, names: Sequence[str], first: int | None = None, end: int | None = None, spellings: Sequence[str] = ()) -> DataFrame:
    """Comments of the named communities, case aside, within [first, end) epoch seconds, which reach the scan.

    ``spellings``, where all that occur are known, reach the scan too; the test without case stays.
    """
    df = archive.where(F.col("created_utc").isNotNull() & F.lower("subreddit").isin(*[n.lower() for n in names]))
    df = df.where(F.col("created_utc") >= first) if first is not None else df
    df = df.where(F.col("created_utc") < end) if end is not None else df
    return df.where(F.col("subreddit").isin(*spellings)) if spellings else df


def archive_days(archive: DataFrame, names: Sequence[str]) -> DataFrame:
    """Comments of the named communities with UTC year, month and day texts."""
    t = F.timestamp_seconds("created_utc")
    return archive_rows(archive, names).withColumns({"year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"), "day": F.date_format(t, "dd")})


def _event(**fields: Column) -> list[Column]:
    """Columns of EVENT in its order; fields that aren't given are null."""
    return [fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT.fields]


def article_events(articles: DataFrame, query: str, collected_at: str, raw: str = "raw") -> DataFrame:
    """Events of an article search's JSON objects, a row each; such without URL, title or time seen are left out."""
    j = F.from_json(raw, "url string, title string, seendate string, language string, domain string, sourcecountry string")
    a = articles.select(*[F.nullif(F.trim(j[c]), F.lit("")).alias(c) for c in ("url", "title", "seendate", "language", "domain", "sourcecountry")])
    seen = F.try_to_timestamp("seendate", F.lit("yyyyMMdd'T'HHmmss'Z'"))
    about = F.create_map(*[F.lit(x) if i % 2 == 0 else x for i, x in enumerate(("domain", F.col("domain"), "source_country", F.col("sourcecountry"), "query", F.lit(query), "text_scope", F.lit("title_only")))])
    return a.where(F.col("url").isNotNull() & F.col("title").isNotNull() & seen.isNotNull()).select(
        *_event(
            event_id=F.sha2(F.concat(F.lit("gdelt:"), "url"), 256), source_type=F.lit("news"), source_name=F.lit("gdelt"), event_time=F.date_format(seen, "yyyy-MM-dd'T'HH:mm:ss'Z'"), collected_at=F.lit(collected_at),
            language=F.lower(F.coalesce("language", F.lit("unknown"))), title=F.col("title"), text=F.col("title"), url=F.col("url"), schema_version=F.lit(1), metadata=about,
        )
    )


def listing_events(pages: DataFrame, start: Column, end: Column, collected_at: str, raw: str = "raw") -> DataFrame:
    """Events of listing pages (JSON, a row a page) within [start, end), each id once; blank and removed comments are left out.

    Of several comments of one id the one with the earliest time, then the least text, stays.
    """
    child = "id: string, body: string, subreddit: string, created_utc: double, score: long, permalink: string, link_id: string, controversiality: int, edited: string"
    body = pages.select(F.explode(F.from_json(raw, f"data struct<children: array<struct<data: struct<{child}>>>>")["data"]["children"]).alias("c")).select("c.data.*")
    c = body.withColumns({"id": F.trim("id"), "body": F.trim("body"), "t": F.timestamp_seconds("created_utc")})
    c = window_events(c.where("id <> '' AND body <> '' AND body NOT IN ('[deleted]', '[removed]')"), start, end, "t")
    c = c.groupBy("id").agg(F.min_by(F.struct(*[x for x in c.columns if x != "id"]), F.struct("t", "body")).alias("v")).select("id", "v.*")
    text = lambda x: F.coalesce(x.cast("string"), F.lit("0"))
    about = F.create_map(*[F.lit(x) if i % 2 == 0 else x for i, x in enumerate(("link_id", F.col("link_id"), "controversiality", text(F.col("controversiality")), "edited", (F.coalesce("edited", F.lit("false")) != "false").cast("string"), "collection_scope", F.lit("current_reddit_comments")))])
    return c.select(
        *_event(
            event_id=F.sha2(F.concat(F.lit("reddit:"), "id"), 256), source_type=F.lit("comment"), source_name=F.lit("reddit"), event_time=F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'"), collected_at=F.lit(collected_at),
            language=F.lit("unknown"), text=F.col("body"), url=F.when(F.trim("permalink") != "", F.concat(F.lit("https://www.reddit.com"), F.trim("permalink"))), community=F.nullif("subreddit", F.lit("")), engagement=F.coalesce("score", F.lit(0)), schema_version=F.lit(1), metadata=about,
        )
    )


def analysis_groups(spark: SparkSession, path: str) -> DataFrame:
    """(group_name, label, news_topic, communities) of a group configuration (JSON, or YAML where its parser is installed)."""
    text = spark.read.text(path, wholetext=True).first().value  # a file written by people
    if path.endswith(".json"):
        groups = json.loads(text)["groups"]
    else:
        import yaml

        groups = yaml.safe_load(text)["groups"]
    rows = [(name, g.get("label"), str(g["news_topic"]), [str(c).lower() for c in g["subreddits"]]) for name, g in groups.items()]
    return spark.createDataFrame(rows, "group_name string, label string, news_topic string, communities array<string>")


_PERIOD = ("event_id", "source_type", "source_name", "event_timestamp", "collected_timestamp", "language", "title", "text", "url", "community", "engagement", "schema_version", "metadata_json")


def comments_to_events(archive: DataFrame, collected_at: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archive comments as events of a period dataset; blank and removed bodies are left out (the test has regard to case)."""
    a = archive.where("created_utc IS NOT NULL AND id IS NOT NULL AND trim(body) <> '' AND body NOT IN ('[deleted]', '[removed]')")
    none = F.lit(None).cast("string")
    return a.select(
        F.sha2(F.concat(F.lit("reddit:"), "id"), 256).alias("event_id"),
        F.lit("comment").alias("source_type"),
        F.lit("reddit").alias("source_name"),
        F.timestamp_seconds("created_utc").alias("event_timestamp"),
        F.to_timestamp(F.lit(collected_at)).alias("collected_timestamp"),
        F.lit("unknown").alias("language"),
        none.alias("title"),
        F.col("body").alias("text"),
        none.alias("url"),
        F.col("subreddit").alias("community"),
        F.col("score").cast("long").alias("engagement"),
        F.lit(1).alias("schema_version"),
        F.to_json(F.struct("link_id", "controversiality")).alias("metadata_json"),
    )


def news_to_events(news: DataFrame, collected_at: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """News (url, title, published) as events: the title is the text, the URL gives the id. Incomplete rows are left out."""
    none = F.lit(None).cast("string")
    n = news.where("trim(url) <> '' AND trim(title) <> '' AND published IS NOT NULL")
    return n.select(
        F.sha2(F.concat(F.lit("web_news:"), "url"), 256).alias("event_id"),
        F.lit("news").alias("source_type"),
        F.lit("web_news").alias("source_name"),
        F.col("published").cast("timestamp").alias("event_timestamp"),
        F.to_timestamp(F.lit(collected_at)).alias("collected_timestamp"),
        F.lit("en").alias("language"),
        F.trim("title").alias("title"),
        F.trim("title").alias("text"),
        F.col("url"),
        none.alias("community"),
        F.lit(None).cast("long").alias("engagement"),
        F.lit(1).alias("schema_version"),
        F.lit("{}").alias("metadata_json"),
    )


def period_dataset(events: DataFrame) -> DataFrame:
    """Events of a period with the year, month and day that its folders are named by."""
    t = F.col("event_timestamp")
    return events.select(*_PERIOD, F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"))


def rss_items(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """``feeds`` with a row an item: title without its publisher, url, publisher, published (UTC). Incomplete items are left out."""
    schema = "channel struct<item: array<struct<title:string,link:string,pubDate:string,source:string>>>"
    item = F.explode(F.from_xml(F.col(xml), schema)["channel"]["item"])
    df = feeds.withColumn("_i", item)
    part = lambda c: F.trim(F.col(f"_i.{c}"))
    title, publisher = part("title"), F.coalesce(F.nullif(part("source"), F.lit("")), F.lit("Unknown"))
    suffix = F.concat(F.lit(" - "), publisher)
    plain = F.when((publisher != "Unknown") & title.endswith(suffix), F.trim(F.left(title, F.length(title) - F.length(suffix)))).otherwise(title)
    zoned = F.regexp_replace(part("pubDate"), r"\s+(GMT|UTC|Z)$", " +0000")
    published = F.try_to_timestamp(F.regexp_replace(zoned, r"^[A-Za-z]+,\s*", ""), F.lit("d MMM yyyy HH:mm:ss Z"))
    out = df.withColumns({"title": plain, "url": part("link"), "publisher": publisher, "published": published})
    return out.where((title != "") & (F.col("url") != "") & F.col("published").isNotNull()).drop("_i", xml)


def html_cards(pages: DataFrame, html: str, card: str, **fields: str) -> DataFrame:
    """``pages`` with a row a card: ``card`` is the pattern of one, ``fields`` give the first group of each pattern in it.

    Entities are decoded; cards without a match for some field have an empty text there.
    """
    df = pages.withColumn("_c", F.explode(F.regexp_extract_all(html, F.lit(f"(?s){card}"), F.lit(0)))).drop(html)
    return df.withColumns({k: F.trim(F.regexp_extract("_c", p, 1)) for k, p in fields.items()}).withColumns({k: kernels.html_unescape(F.col(k)) for k in fields}).drop("_c")


def select_cards(pages: DataFrame, html: str, card: str, **fields: str) -> DataFrame:
    """``pages`` with a row a card: ``card`` selects them, each of ``fields`` is a selector within it that ends in ::text or ::attr(name).

    Cards may be nested, tags left open and attributes in any order; entities are decoded. A field
    without a match is null. ``html_cards`` does the same by patterns, in the JVM, for pages of one known form.
    """
    df = pages.withColumn("_c", F.explode(cards.cards(F.col(html), card, tuple(fields.values())))).drop(html)
    return df.withColumns({k: F.col("_c")[i] for i, k in enumerate(fields)}).drop("_c")


def window_events(events: DataFrame, start: Column, end: Column, time: str = "event_timestamp") -> DataFrame:
    return events.where((F.col(time) >= start) & (F.col(time) < end))


def artifact_routes(paths: DataFrame, path: str) -> DataFrame:
    """``paths`` of data artifacts (data/<folder>/…) with bucket and key; unfinished files are left out, other folders have nulls."""
    p = F.col(path)
    folder, rest = F.regexp_extract(p, r"^data/([^/]+)/", 1), F.regexp_extract(p, r"^data/[^/]+/(.+)$", 1)
    bucket = prefix = F.lit(None).cast("string")
    for name, (b, k) in ARTIFACTS.items():
        bucket, prefix = F.when(folder == name, b).otherwise(bucket), F.when(folder == name, k).otherwise(prefix)
    return paths.where(~p.rlike("|".join(EXCLUDED))).withColumns({"bucket": bucket, "key": F.concat(prefix, F.lit("/"), rest)})


#: Texts by index % 100 that show one kind of defect each (fixed values of the generator).
GENERATED = """CASE i % 100 WHEN 5 THEN 'visible\\u200bhidden' WHEN 10 THEN repeat('x', 150) WHEN 15 THEN 'https://a.example/x https://b.example/y'
  WHEN 20 THEN 'Contact sample.user@example.com for details.' WHEN 25 THEN concat('a', repeat('\\u0301', 10)) WHEN 30 THEN repeat('abcdefghij ', 500) WHEN 35 THEN repeat('\\U0001F600', 16385)
  WHEN 40 THEN '[removed]' WHEN 45 THEN 'control\\u0000character' ELSE concat('Synthetic discussion text number ', i, ' about technology and society.') END"""


def generate(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    """Synthetic events; every fiftieth repeats the one before. Made on the executors, the same in any partitioning."""
    return synthetic(spark.range(0, rows, 1, partitions) if partitions else spark.range(rows))


def synthetic(numbers: DataFrame) -> DataFrame:
    """A synthetic event for each ``id`` of ``numbers``."""
    df = numbers.selectExpr("id", "id - CASE WHEN id > 0 AND id % 50 = 0 THEN 1 ELSE 0 END AS i")
    news, iso = F.col("i") % 2 == 0, "yyyy-MM-dd'T'HH:mm:ss'Z'"
    time = F.timestamp_seconds(F.lit(1_767_225_600) + F.col("i"))
    name = F.when(news, "gdelt").otherwise("reddit")
    df = df.withColumn("text", F.expr(GENERATED))
    return df.select(
        F.sha2(F.concat(name, F.lit(":synthetic-"), F.col("i").cast("string")), 256).alias("event_id"),
        F.when(news, "news").otherwise("comment").alias("source_type"),
        name.alias("source_name"),
        F.date_format(time, iso).alias("event_time"),
        F.date_format(F.timestamp_seconds(F.unix_seconds(time) + 300), iso).alias("collected_at"),
        F.when(news, "english").otherwise("unknown").alias("language"),
        F.when(news, F.col("text")).alias("title"),
        "text",
        F.when(news, F.concat(F.lit("https://example.com/news/"), F.col("i").cast("string"))).alias("url"),
        F.when(~news, F.concat(F.lit("community_"), (F.col("i") % 10).cast("string"))).alias("community"),
        F.when(~news, F.col("i") % 41 - 10).alias("engagement"),
        F.lit(1).alias("schema_version"),
        F.create_map(F.lit("text_scope"), F.when(news, "title_only").otherwise("comment")).alias("metadata"),
    )
