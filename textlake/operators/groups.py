"""Topic groups, period coverage, balanced weighting, profiles and the grouped cost model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.text import flat_line, split_tags

TOMBSTONES = ("[deleted]", "[removed]")


def by_community(events: DataFrame, groups: DataFrame) -> DataFrame:
    """``events`` of communities in ``groups`` (group_name, communities), case aside, with group_name.

    ``groups`` is configuration; Spark broadcasts it while it is small.
    """
    dim = groups.select("group_name", F.explode("communities").alias("_c")).withColumn("_c", F.lower("_c"))
    return events.join(dim, F.lower(events["community"]) == F.col("_c")).drop("_c")


def by_tags(events: DataFrame, groups: DataFrame, tags: str) -> DataFrame:
    """A row for each event and selected group among its comma-separated ``tags``."""
    names = groups.select("group_name")
    return events.withColumn("group_name", F.explode(split_tags(F.col(tags)))).join(names, "group_name", "left_semi")


def eligible(text: Column, most_bytes: int | None = None) -> Column:
    """Not blank, no tombstone whatever its case, and of ``most_bytes`` bytes at most where that is set."""
    t = F.trim(text)
    ok = F.coalesce((t != "") & ~F.lower(t).isin(*TOMBSTONES), F.lit(False))
    return ok if most_bytes is None else ok & (F.octet_length(t) <= most_bytes)


def daily_counts(rows: DataFrame, text: str, most_bytes: int) -> DataFrame:
    """By day and group_name: eligible rows, tokens of texts cut at ``most_bytes``, rejected and cut rows."""
    size = F.octet_length(F.trim(text))
    ok = eligible(F.col(text))
    token = F.greatest(F.lit(1).cast("long"), F.shiftright(F.least(size, F.lit(most_bytes)) + 3, 2).cast("long"))
    return rows.groupBy("day", "group_name").agg(
        F.count_if(ok).alias("row_count"),
        F.coalesce(F.sum(F.when(ok, token)), F.lit(0)).alias("tokens"),
        F.count_if(~ok).alias("rejected_rows"),
        F.count_if(ok & (size > most_bytes)).alias("cut_rows"),
    )


def comparison_target(daily: DataFrame, comparison: str) -> DataFrame:
    """By day: rows to sample of the comparison group, the mean of the other groups' rounded half up, and their tokens."""
    topic = F.col("group_name") != comparison
    d = daily.groupBy("day").agg(
        F.coalesce(F.sum(F.when(topic, F.col("row_count"))), F.lit(0)).alias("topic_rows"),
        F.coalesce(F.sum(F.when(~topic, F.col("row_count"))), F.lit(0)).alias("available"),
        F.coalesce(F.sum(F.when(~topic, F.col("tokens"))), F.lit(0)).alias("available_tokens"),
    )
    groups = daily.where(topic).agg(F.count_distinct("group_name").alias("groups"))
    d = d.join(F.broadcast(groups), F.lit(True))  # one row
    d = d.withColumn("target_rows", F.least(F.expr("CASE WHEN groups > 0 THEN (topic_rows + groups div 2) div groups ELSE 0 END"), "available"))
    tokens = F.expr("CASE WHEN available > 0 THEN (target_rows * available_tokens + available - 1) div available ELSE 0 END")
    return d.withColumn("target_tokens", tokens).drop("groups")


def map_requests(daily: DataFrame, chunk_tokens: int) -> DataFrame:
    """``daily`` with expected and most map requests, the latter with a quarter more tokens."""
    up = lambda c, by: F.expr(f"CAST(({c} + {by} - 1) div {by} AS BIGINT)")
    return daily.withColumns({"map_requests": up("tokens", chunk_tokens), "most_map_requests": up("tokens * 5", 4 * chunk_tokens)})


def cost_model(daily: DataFrame, news_tokens: Column, per_day: int = 5, prices: tuple[str, str] = ("0.10", "0.60")) -> DataFrame:
    """One row of expected and most tokens and dollars of the two-stage model (map, daily and monthly reduce).

    ``daily`` has a row a day and group with tokens, map_requests and most_map_requests; overheads and
    outputs a request are the model's fixed values: 500, 500 and 1,000 tokens of prompt, 250, 250 and
    400 of output, 500, 500 and 800 at most. At most there are a quarter more tokens of text and news.
    """
    s = daily.agg(F.sum("tokens").alias("t"), F.sum("map_requests").alias("m"), F.sum("most_map_requests").alias("mm"), F.count_distinct("day").alias("days"), F.coalesce(F.sum(news_tokens), F.lit(0)).alias("news"))
    reduces = F.col("days") * per_day
    s = s.withColumns(
        {
            "input_tokens": F.col("t") + F.col("m") * 750 + reduces * 750 + F.col("news") * 2 + per_day * 1000,
            "output_tokens": F.col("m") * 250 + reduces * 250 + per_day * 400,
            "most_input_tokens": F.ceil((F.col("t") + F.col("news") * 2) * 1.25 + F.col("mm") * 1000 + reduces * 1000 + per_day * 1000),
            "most_output_tokens": F.col("mm") * 500 + reduces * 500 + per_day * 800,
        }
    )
    from ..functions.cost import cost

    dollars = lambda a, b: cost(F.col(a), F.col(b), *prices)
    return s.select(
        *["input_tokens", "output_tokens", dollars("input_tokens", "output_tokens").alias("cost_usd")],
        *["most_input_tokens", "most_output_tokens", dollars("most_input_tokens", "most_output_tokens").alias("most_cost_usd")],
    )


def source_weights(rows: DataFrame) -> DataFrame:
    """By group_name: rows and weight a record of comments and news, half and half where both are there."""
    c, n = F.count_if(F.col("source_name") == "reddit"), F.count_if(F.col("source_name") == "web_news")
    d = rows.groupBy("group_name").agg(c.alias("comment_rows"), n.alias("news_rows"))
    both = (F.col("comment_rows") > 0) & (F.col("news_rows") > 0)
    weight = lambda k: F.when(F.col(k) == 0, 0.0).otherwise(F.round(F.when(both, 0.5).otherwise(1.0) / F.col(k), 12))
    return d.withColumns({"comment_weight": weight("comment_rows"), "news_weight": weight("news_rows")})


def period_coverage(events: DataFrame, text: str) -> DataFrame:
    """By month and by day (null for the month's row) and source: all and eligible rows. One pass, grouping sets."""
    e = events.withColumn("_ok", eligible(F.col(text)))
    sets = e.groupingSets([[F.col("month"), F.col("day"), F.col("source_name")], [F.col("month"), F.col("source_name")]], "month", "day", "source_name")
    return sets.agg(F.count("*").alias("total_rows"), F.count_if(F.col("_ok")).alias("eligible_rows"))


def community_profile(events: DataFrame, label: str, text: str, sampled_days: int = 1, period_days: int = 30) -> DataFrame:
    """By community without regard to case: commonest spelling (the least among equals), rows and bytes, rows by label as a map.

    Also the mean MiB of the ``sampled_days`` that the events are of, and the GiB that ``period_days`` would have.
    """
    size = F.octet_length(text)
    per = events.where(F.col("community").isNotNull()).groupBy(F.lower("community").alias("key"), "community", label).agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b"))
    spelled = per.groupBy("key", "community").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    names = spelled.groupBy("key").agg(F.min_by("community", F.struct((-F.col("n")).alias("m"), "community")).alias("community"), F.sum("n").alias("row_count"), F.sum("b").alias("bytes"))
    labels = per.groupBy("key", label).agg(F.sum("n").alias("n")).groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), "n"))).alias("labels"))
    daily = F.col("bytes") / sampled_days
    return names.join(labels, "key").withColumns({"average_daily_mib": F.round(daily / 2**20, 4), "projected_period_gib": F.round(daily * period_days / 2**30, 4)})


def coverage_header(rows: DataFrame) -> DataFrame:
    """By group_name: rows a community as sorted entries, and in all."""
    per = rows.groupBy("group_name", F.lower("community").alias("community")).agg(F.count("*").alias("n"))
    return per.groupBy("group_name").agg(F.array_sort(F.collect_list(F.struct("community", "n"))).alias("communities"), F.sum("n").alias("row_count"))


def merge_urls(rows: DataFrame, url: Column) -> DataFrame:
    """By URL: the smallest id, rows, and the union of topic groups, sorted.

    Rows are first counted by URL and tags, then by URL and tag, so a URL that many rows have brings
    its distinct tags together and nothing else.
    """
    per = rows.groupBy(url.alias("url"), "topic_groups").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    tags = per.select("url", F.explode_outer(split_tags(F.col("topic_groups"))).alias("t")).distinct()
    union = tags.groupBy("url").agg(F.array_join(F.array_sort(F.collect_list("t")), ",").alias("topic_groups"))
    return per.groupBy("url").agg(F.min("doc_id").alias("doc_id"), F.sum("n").alias("row_count")).join(union, "url")


def capped_requests(items: DataFrame, by: tuple[str, ...], cap: int = 100) -> DataFrame:
    """By request: its items, and whether they reach the ``cap`` of a search index, so that some may be missing."""
    return items.groupBy(*by).agg(F.count("*").alias("row_count")).withColumn("hit_cap", F.col("row_count") >= cap)


def top_publishers(rows: DataFrame, url: Column, publisher: str, n: int = 30) -> DataFrame:
    """Publishers of the most distinct URLs, a URL counted for the publisher of its smallest id."""
    first = rows.groupBy(url.alias("_u")).agg(F.min_by(publisher, F.struct("doc_id", publisher)).alias(publisher))
    return first.groupBy(publisher).agg(F.count("*").alias("url_count")).orderBy(F.desc("url_count"), publisher).limit(n)


def prompt_lines(events: DataFrame, by: tuple[str, ...] = ("day",)) -> DataFrame:
    """``events`` that a prompt takes, with their line and its place among the lines of its ``by`` and kind.

    Comments (R) have community and text and are sorted by both, the community without regard to
    case; news (N) has the title. Line ends become blanks and nothing is cut. The window sorts one
    prompt's lines, which its requests' limits bound.
    """
    r = F.col("source_name") == "reddit"
    text = F.when(r, F.col("text")).otherwise(F.col("title"))
    line = F.concat_ws("\t", F.when(r, "R").otherwise("N"), F.when(r, F.lower("community")), flat_line(text))
    rows = events.where(eligible(text)).withColumns({"kind": F.when(r, "R").otherwise("N"), "line": line})
    order = Window.partitionBy(*by, "kind").orderBy(F.lower("community"), text, "doc_id")
    return rows.withColumn("place", F.row_number().over(order))
