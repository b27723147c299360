"""Mixing sources to target weights (DataFrame functions only).

Every document gets a hash-random key. Its leading digits are its range within its source, so the
ranges of a source are even whatever the source's share of the rows is. Sums per range give
distributed prefix sums in two steps: over the ranges of a source, then over the sorted rows of the
one range that holds the source's cut. All rows before the cut are taken whole and none behind it, so
no document is dealt anew. A source is cut at its exact budget; budgets above its size repeat it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .scratch import apart, if_small, scope, table, written

#: ASCII white space splits words; everything else belongs to one.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Targets from ``sizes(mx_source, mx_total)``, one row a source.

    Sources in key order take the weights in turn and share the sum of all totals. A target ends at
    ``cap`` times its source's total; the excess goes to the others by weight until none is above:
    sorted by cap/weight the capped sources are a prefix, so one pass of running sums finds them.
    The window without a key sees one row a source, never rows of documents.
    """
    whole = Window.partitionBy(F.lit(0))
    turn = (F.row_number().over(whole.orderBy("mx_source")) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in weights]), (turn + 1).cast("int"))
    before = whole.orderBy(F.col("mx_cap") / F.col("mx_w"), "mx_source").rowsBetween(Window.unboundedPreceding, -1)
    left = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    df = sizes.withColumn("mx_w", w).withColumn("mx_cap", F.col("mx_total") * cap)
    df = df.withColumns({"mx_sum": F.sum("mx_total").over(whole), "mx_wsum": F.sum("mx_w").over(whole), "mx_pc": left("mx_cap"), "mx_pw": left("mx_w")})
    df = df.withColumn("mx_capped", F.col("mx_cap") * (F.col("mx_wsum") - F.col("mx_pw")) <= F.col("mx_w") * (F.col("mx_sum") - F.col("mx_pc")))
    gone = lambda c: F.sum(F.when(F.col("mx_capped"), F.col(c)).otherwise(0)).over(whole)
    df = df.withColumns({"mx_num": F.col("mx_w") * (F.col("mx_sum") - gone("mx_cap")), "mx_den": F.col("mx_wsum") - gone("mx_w")})
    free = ~F.col("mx_capped")
    return df.select(
        "mx_source",
        "mx_total",
        F.when(free, F.expr("CAST(mx_num AS DOUBLE) / CAST(mx_den AS DOUBLE)")).otherwise(F.col("mx_cap").cast("double")).alias("mx_target"),
        F.when(free, F.expr("CASE WHEN mx_den > 0 THEN mx_num div mx_den END")).otherwise(F.col("mx_cap")).alias("mx_budget"),
    )


def cut_points(base: DataFrame, digits: int, weights: tuple[int, ...], cap: int) -> DataFrame:
    """A row a source of ``base`` (mx_source, mx_key, mx_text): its total, target and where its budget ends.

    mx_full epochs are taken whole. In the next one the rows before mx_cut in the order of keys are
    taken whole, and those with that key take mx_left words together; they are mx_ties rows. Ranges
    of keys give sums and prefix sums first. One range of a source holds the cut, so only its rows are
    sorted, as sums by key; the largest window holds one range of one source.
    """
    sized = base.withColumn("mx_size", word_count(F.col("mx_text")))
    ranges = written(sized.groupBy("mx_source", F.substring("mx_key", 1, digits).alias("mx_range")).agg(F.sum("mx_size").alias("mx_sum")), "mix-ranges")
    targets = source_targets(ranges.groupBy("mx_source").agg(F.sum("mx_sum").alias("mx_total")), weights, cap)
    targets = targets.withColumn("mx_full", F.expr("CASE WHEN mx_total > 0 THEN mx_budget div mx_total ELSE 0 END"))
    targets = written(targets.withColumn("mx_rest", F.expr("mx_budget - mx_full * mx_total")), "mix-targets")
    before = lambda by, order: F.coalesce(F.sum("mx_sum").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    holds = "mx_before <= mx_rest AND mx_rest < mx_before + mx_sum"
    cut = ranges.withColumn("mx_before", before(["mx_source"], "mx_range")).join(targets.select("mx_source", "mx_rest"), "mx_source").where(holds)
    cut = written(cut.select("mx_source", "mx_range", (F.col("mx_rest") - F.col("mx_before")).alias("mx_rest")), "mix-cut-ranges")
    inside = base.withColumn("mx_range", F.substring("mx_key", 1, digits)).join(if_small(cut), ["mx_source", "mx_range"])
    keys = inside.groupBy("mx_source", "mx_rest", "mx_key").agg(F.sum(word_count(F.col("mx_text"))).alias("mx_sum"), F.count("*").alias("mx_ties"))
    at = keys.withColumn("mx_before", before(["mx_source"], "mx_key")).where(holds)
    at = at.select("mx_source", F.col("mx_key").alias("mx_cut"), (F.col("mx_rest") - F.col("mx_before")).alias("mx_left"), "mx_ties")
    return written(targets.drop("mx_rest").join(at, "mx_source", "left"), "mix-cuts", keep=True)


def mix_sources(docs: DataFrame, carry: list[str], weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, range_digits: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One row a document: ``carry`` columns, then mx_size, mx_source_size, mx_target, mx_taken and mx_epochs.

    mx_taken counts the words that the mix takes of the document, repeats counted, and mx_epochs has
    them by epoch; a source's sum is its target's whole part exactly, since the last document is cut
    at the budget. A null source is a source of its own, after all others; a null or empty text has
    size 0 and nothing is taken of it. The order is by md5 of id and text, so reruns agree; rows alike
    in both are interchangeable. An empty table gives no rows. There are 16**``range_digits`` ranges,
    else about as many as the root of the counted rows: no window has many more rows than that root,
    whatever the share of a source. A carried column of a
    result's name gets an underscore behind it. Documents stay where they are:
    they meet their source's cut, broadcast where these take at most ``broadcast_bytes``, else by key.
    """
    spark = docs.sparkSession
    src, ident, text = docs[source_col], docs[id_col], docs[text_col]
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(ident.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    base = docs.select(
        *[docs[c].alias(f"mx_c{i}") for i, c in enumerate(carry)],
        F.when(src.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), src)).alias("mx_source"),
        text.alias("mx_text"),
        key.alias("mx_key"),
    )
    digits = range_digits or max(1, round(math.log(max(1, docs.count()), 16) / 2))
    with scope(spark):
        cuts = cut_points(base.select("mx_source", "mx_text", "mx_key"), digits, weights, cap)
    rows = base.join(if_small(cuts, broadcast_bytes), "mx_source").withColumn("mx_size", word_count(F.col("mx_text")))
    size, left = F.col("mx_size"), F.col("mx_left")
    if cuts.where("mx_ties > 1").isEmpty():
        at_cut = F.least(size, left)
    else:  # rows with a cut's key are alike, so any order of them will do
        place = F.row_number().over(Window.partitionBy("mx_source").orderBy("mx_key"))
        rows = rows.where("NOT mx_key <=> mx_cut").withColumn("mx_turn", F.lit(0)).unionByName(rows.where("mx_key = mx_cut").withColumn("mx_turn", place - 1))
        at_cut = F.greatest(F.lit(0).cast("long"), F.least(size, left - F.col("mx_turn") * size))
    part = F.when(F.col("mx_key") < F.col("mx_cut"), size).when(F.col("mx_key") == F.col("mx_cut"), at_cut).otherwise(F.lit(0).cast("long"))
    epochs = F.array(*[F.when(F.lit(e) < F.col("mx_full"), size).when(F.lit(e) == F.col("mx_full"), part).otherwise(F.lit(0).cast("long")) for e in range(cap)])
    taken = F.aggregate(epochs, F.lit(0).cast("long"), lambda a, x: a + x)
    names = apart(carry, ("mx_size", "mx_source_size", "mx_target", "mx_taken", "mx_epochs"))
    return rows.select(*[F.col(f"mx_c{i}").alias(c) for i, c in enumerate(names)], "mx_size", F.col("mx_total").alias("mx_source_size"), "mx_target", taken.alias("mx_taken"), epochs.alias("mx_epochs"))


def query(spark, sf_dir) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), ["doc_id"])
    return mixed.select("doc_id", F.col("mx_size").alias("size"), F.col("mx_source_size").alias("source_size"), F.col("mx_target").alias("target"), F.col("mx_taken").alias("taken"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a document once for each epoch that takes words of it, with epoch and words taken."""
    carry = ["doc_id", "text", "lang", "source", "n_chars"]
    mixed = mix_sources(docs, carry)
    return mixed.select(*carry, F.col("mx_size").alias("size"), F.col("mx_source_size").alias("source_size"), F.col("mx_target").alias("target"), F.posexplode("mx_epochs").alias("epoch", "taken")).where("taken > 0")


SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(':' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS total FROM d GROUP BY src),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY src) - 1) % 3 + 1] AS w, 3 * total AS cap FROM s),
p AS (SELECT *, sum(total) OVER () AS t, sum(w) OVER () AS ws,
             coalesce(sum(cap) OVER o, 0) AS pc, coalesce(sum(w) OVER o, 0) AS pw
      FROM w WINDOW o AS (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap * (ws - pw) <= w * (t - pc) AS capped FROM p),
n AS (SELECT *, w * (t - coalesce(sum(cap) FILTER (capped) OVER (), 0)) AS num, ws - coalesce(sum(w) FILTER (capped) OVER (), 0) AS den FROM c),
g AS (SELECT src, total, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE CAST(num AS DOUBLE) / CAST(den AS DOUBLE) END AS target,
             CASE WHEN capped THEN cap WHEN den > 0 THEN num // den END AS budget FROM n),
a AS (SELECT d.*, g.*, sum(size) OVER (PARTITION BY d.src ORDER BY k ROWS UNBOUNDED PRECEDING) - size AS pos FROM d JOIN g ON d.src = g.src)
SELECT doc_id, size, total AS source_size, target,
       CAST(greatest(0, least(size, budget - pos)) + greatest(0, least(size, budget - total - pos)) + greatest(0, least(size, budget - 2 * total - pos)) AS BIGINT) AS taken
FROM a
"""
