"""URL filters from association rules (DataFrame functions and Spark's FP-growth only).

A URL becomes a set of tokens. FP-growth over labelled URLs finds token sets that come with the bad
label; those with enough support, confidence and lift are rules, less the ones that a shorter rule
covers. Tokens that are in the same labelled URLs are mined as one, and tokens that are rules by
themselves are taken out before the mining, as no longer rule with one of them is kept; so deep paths of
which many are alike don't make a rule of each subset. A rule is filed under its rarest token, so a URL
meets only rules that share it, and distinct token sets meet them, not URLs. Listed host and path rules
come first.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import if_small, scope, table, written

#: (verdict, host and path) of the listed rules; the longest that fits a URL decides.
LISTED = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD, GOOD = "label=bad", "label=good"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty if the URL is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: parts of the host, parts of the path, names and values in the query; none has only digits and dots."""
    mark = lambda a, m: F.transform(a, lambda x: F.concat(F.lit(m), x))
    asked = F.regexp_extract(url, r"[?]([^#]*)", 1)
    parts = F.concat(
        mark(F.split(host, "[.-]"), "h:"),
        mark(F.split(F.regexp_replace(path, "^/", ""), "/"), "p:"),
        mark(F.regexp_extract_all(asked, F.lit(r"(?:^|&)([^=&]+)"), 1), "q:"),
        mark(F.regexp_extract_all(asked, F.lit(r"(?:^|&)[^=&]*=([^&]+)"), 1), "v:"),
    )
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(parts, F.array()), lambda x: x.rlike(r"(?s)^...*[^\d.]"))))


def listed_rule(host: Column, path: Column, rules=LISTED) -> Column:
    """The longest rule that fits, or null. ``rules`` is configuration, a list written by people."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, slash, p = rule.partition("/")
        out = F.when(((host == h) | host.endswith("." + h)) & path.startswith(slash + p), F.lit(rule)).otherwise(out)
    return out


def listed_bad(rule: Column, rules=LISTED) -> Column:
    """Whether a listed rule blocks; null where there is none."""
    out = F.lit(None).cast("boolean")
    for what, name in rules:
        out = F.when(rule == name, F.lit(what == "block")).otherwise(out)
    return out


def mine(labelled: DataFrame, support: float = 0.002, confidence: float = 0.8, lift: float = 1.5, least_rows: int = 20) -> tuple[DataFrame, DataFrame]:
    """Rules (antecedent, rare: its rarest token, confidence, support) from ``labelled`` (tokens, bad), and (token, rep).

    Rules speak of rep, the least of the tokens that are in the same labelled rows; any of these
    stands for it, as each would make the same rule. Tokens without a rep are in no rule.

    FP-growth spreads its conditional trees over partitions; an item set needs ``support`` of all
    labelled rows and ``least_rows`` of them, so their number doesn't follow the input. It does list every
    frequent set of tokens of which none is a rule by itself: n such tokens that are together in most
    ways, in URLs of both labels, are 2 ** n sets. No labelled rows give no rules.
    """
    spark = labelled.sparkSession
    empty = "antecedent array<string>, rare string, confidence double, support double"
    rows = written(labelled.select("tokens", "bad"), "url-labelled")
    n = rows.count()
    if n < least_rows:
        return spark.createDataFrame([], empty), spark.createDataFrame([], "token string, rep string")
    each = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "bad", F.explode_outer("tokens").alias("token"))
    where = each.where("token IS NOT NULL").groupBy("token").agg(F.count("*").alias("k"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("h"), F.min("row").alias("r"))
    alike = where.where(F.col("k") >= max(support * n, least_rows - 0.5)).groupBy("k", "h", "r").agg(F.min("token").alias("rep"), F.collect_list("token").alias("tokens"))
    same = written(alike.select(F.explode("tokens").alias("token"), "rep"), "url-tokens")  # as many as tokens can have the support
    least, share = max(support, (least_rows - 0.5) / n), rows.agg(F.sum(F.col("bad").cast("int"))).first()[0] / n
    placed = each.join(F.broadcast(same), "token", "left").select("row", "bad", "rep").distinct()
    good_rule = (F.col("bad_rows") >= math.ceil(least * n)) & (F.col("confidence") >= confidence) & (F.col("confidence") / F.lit(share) >= lift)
    alone = placed.where("rep IS NOT NULL").groupBy("rep").agg(F.sum(F.col("bad").cast("int")).alias("bad_rows"), F.count("*").alias("k"))
    alone = written(alone.withColumn("confidence", F.col("bad_rows") / F.col("k")).withColumn("rule", good_rule), "url-alone")  # a row a rep, as few as those
    left = placed.join(F.broadcast(alone.where("rule").select("rep", "rule")), "rep", "left").withColumn("rep", F.when(F.col("rule").isNull(), F.col("rep")))
    items = F.array_append(F.collect_set("rep"), F.when(F.col("bad"), F.lit(BAD)).otherwise(F.lit(GOOD)))
    rows = written(left.groupBy("row", "bad").agg(items.alias("items")), "url-items")
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence).fit(rows)
    frequent = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    found = model.associationRules.where((F.col("consequent")[0] == BAD) & (F.col("lift") >= lift) & ~F.array_contains("antecedent", GOOD) & (F.size("antecedent") > 1))
    found = found.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    rare = found.select("*", F.explode("antecedent").alias("token")).join(frequent, "token").groupBy("antecedent", "confidence", "support").agg(F.min_by("token", F.struct("freq", "token")).alias("rare"))
    single = alone.where("rule").select(F.array("rep").alias("antecedent"), "confidence", (F.col("bad_rows") / n).alias("support"), F.col("rep").alias("rare"))
    rare = written(rare.unionByName(single), "url-rules")
    # a rule with a part of its tokens removed that is a rule too adds nothing; the shorter's rarest token is in the longer
    shorter = rare.select(F.col("antecedent").alias("s"), F.col("rare").alias("token"))
    covered = rare.select("antecedent", F.explode("antecedent").alias("token")).join(shorter, "token").where((F.size("s") < F.size("antecedent")) & (F.size(F.array_except("s", "antecedent")) == 0))
    found = rare.join(covered.select("antecedent").distinct(), "antecedent", "left_anti")
    return written(found.select("antecedent", "rare", "confidence", "support"), "url-index"), same


def blocked(keyed: DataFrame, known: DataFrame, **mining) -> DataFrame | None:
    """(uf_key, uf_hit) of the token sets of ``keyed`` (uf_key, uf_tokens) that a rule mined from ``known`` blocks; None without rules.

    A set meets the rules filed under its tokens, and those whose tokens it has all decide.
    """
    index, same = mine(known, **mining)
    if index.isEmpty():
        return None
    sets = keyed.distinct().select("uf_key", F.explode("uf_tokens").alias("token")).join(F.broadcast(same), "token").groupBy("uf_key").agg(F.collect_set("rep").alias("uf_tokens"))
    met = sets.select("uf_key", "uf_tokens", F.explode("uf_tokens").alias("rare")).join(index, "rare")
    hit = met.where(F.size(F.array_except("antecedent", "uf_tokens")) == 0).select("uf_key").distinct().withColumn("uf_hit", F.lit(True))
    return written(hit, "url-blocked", keep=True)


def judge(pages: DataFrame, labels: DataFrame, carry: list[str], url_col: str = "url", rules=LISTED, broadcast_bytes: int = 32 << 20, **mining) -> DataFrame:
    """``carry`` columns, host, path, rule and verdict of each row of ``pages``.

    ``labels`` has url and bad (boolean, null rows are passed over). verdict is the listed rule's,
    else block where a mined rule's tokens are all in the URL, else allow. Null URLs and such without
    ``://`` have no tokens and are allowed. Repeated rows give a row each, URLs are read whole
    whatever their length, and an empty table of pages or labels gives no rows or no mined rules.
    Token sets that rules block are joined back broadcast where they take at most ``broadcast_bytes``,
    else by key. Tables that only this needs are removed at its end.
    """

    def parsed(df: DataFrame, url: str, keep: list[Column]) -> DataFrame:
        host, path = host_and_path(df[url])
        return df.select(*keep, df[url].alias("uf_url"), host.alias("uf_host"), path.alias("uf_path")).withColumn("uf_tokens", tokens(F.col("uf_host"), F.col("uf_path"), F.col("uf_url")))

    known = parsed(labels, "url", [labels["bad"].alias("bad")]).where("bad IS NOT NULL").select(F.col("uf_tokens").alias("tokens"), "bad")
    rows = parsed(pages, url_col, [pages[c].alias(f"uf_c{i}") for i, c in enumerate(carry)])
    rows = rows.withColumns({"uf_rule": listed_rule(F.col("uf_host"), F.col("uf_path"), rules), "uf_key": F.array_join("uf_tokens", " ")})
    with scope(pages.sparkSession):
        bad = blocked(rows.where("uf_rule IS NULL").select("uf_key", "uf_tokens"), known, **mining)
    if bad is None:
        rows = rows.withColumn("uf_bad", F.lit(False))
    else:
        rows = rows.join(if_small(bad, broadcast_bytes), "uf_key", "left").withColumn("uf_bad", F.coalesce("uf_hit", F.lit(False)))
    verdict = F.when(F.coalesce(listed_bad(F.col("uf_rule"), rules), F.col("uf_bad")), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(*[F.col(f"uf_c{i}").alias(c) for i, c in enumerate(carry)], F.col("uf_host").alias("host"), F.col("uf_path").alias("path"), F.col("uf_rule").alias("rule"), verdict.alias("verdict"))


def query(spark, sf_dir) -> DataFrame:
    """Labels: what a listed rule says of a page's URL; where none fits, its row in ``labels`` (page_id = doc_id), bad if toxic or of low quality."""
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    said = labels.select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("said"))
    listed = listed_bad(listed_rule(*host_and_path(F.col("url"))))
    return judge(pages, pages.join(said, "page_id", "left").select("url", F.coalesce(listed, F.col("said")).alias("bad")), ["page_id"])


#: Mining as SQL tries every subset of a URL's tokens, so it is for small tables.
SQL = r"""
WITH a AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
b AS (SELECT page_id, url, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '[?]([^#]*)', 1) AS asked FROM a),
c AS (SELECT row_number() OVER () AS rid, *,
             CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
             list_distinct(list_filter(
               list_transform(string_split_regex(host, '[.-]'), lambda x: 'h:' || x)
               || list_transform(string_split(regexp_replace(path, '^/', ''), '/'), lambda x: 'p:' || x)
               || list_transform(coalesce(regexp_extract_all(asked, '(?:^|&)([^=&]+)', 1), []), lambda x: 'q:' || x)
               || list_transform(coalesce(regexp_extract_all(asked, '(?:^|&)[^=&]*=([^&]+)', 1), []), lambda x: 'v:' || x),
               lambda x: regexp_matches(x, '(?s)^...*[^0-9.]'))) AS tokens FROM b),
l AS (SELECT row_number() OVER () AS lid, rid, tokens, bad FROM (
        SELECT rid, tokens, CASE WHEN rule IS NULL THEN toxic = 1 OR quality = 0 ELSE rule IN ('net/', 'example.com/de/') END AS bad FROM c LEFT JOIN labels ON doc_id = page_id) WHERE bad IS NOT NULL),
t AS (SELECT count(*) AS n, count(*) FILTER (bad) AS nb FROM l),
w AS (SELECT token, list(lid ORDER BY lid) AS lids FROM (SELECT lid, unnest(tokens) AS token FROM l) GROUP BY token),
k AS (SELECT unnest(list(token)) AS token, min(token) AS rep FROM w, t WHERE len(lids) >= greatest(0.002 * n, 19.5) GROUP BY lids),
s AS (SELECT rid, list_filter(reps, lambda x, i: (m >> (i - 1)) & 1 = 1) AS sub
      FROM (SELECT rid, reps, unnest(range(1, 1 << len(reps))) AS m FROM (SELECT rid, list(DISTINCT rep ORDER BY rep) AS reps FROM (SELECT rid, unnest(tokens) AS token FROM c) JOIN k USING (token) GROUP BY rid))),
f AS (SELECT sub, count(*) AS ns, count(*) FILTER (bad) AS nsb FROM s JOIN l USING (rid) GROUP BY sub),
g AS (SELECT sub FROM f, t WHERE n >= 20 AND nsb >= ceil(greatest(0.002, 19.5 / n) * n) AND nsb >= 0.8 * ns AND (nsb / ns) / (nb / n) >= 1.5),
h AS (SELECT DISTINCT rid FROM s JOIN g USING (sub))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') OR rule IS NULL AND rid IN (SELECT rid FROM h) THEN 'block' ELSE 'allow' END AS verdict FROM c
"""
