"""Quality rules with adaptive thresholds (DataFrame functions only).

Base figures come from one pass over the text. Each figure's distribution within a language and
source is a histogram sketch with logarithmic bins (64 bins a power of two, so quantiles are within
1/64 of their value); sketches merge by adding counts, so a group too small for its own thresholds
takes its language's sketch, or that of all. Fences from the quartiles then join back to the rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .scratch import apart, if_small, scope, table, written

SPACE = r"[\x20\x09-\x0D]+"
#: Figures: name, numerator, denominator, scale, least slack in scaled units, whether low values fail too.
RATIOS = (
    ("word_len", "word_chars", "n_words", 100, 60, True),
    ("symbol", "n_symbols", "n_words", 1000, 100, False),
    ("dup_line", "n_dup_lines", "n_lines", 1000, 350, False),
    ("repeat", "n_repeat_words", "n_words", 1000, 180, False),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, n: int = 5) -> Column:
    """Words in windows of ``n`` words that the array holds twice or more.

    Windows are compared by 64-bit hashes of their words' 64-bit hashes. Only texts with an equal
    pair are sorted by (hash, position); the union of the windows found is then a sum over positions.
    """

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def union(s: Column) -> Column:
            near = lambda e, i, d: F.coalesce(F.get(s, i + d)["h"] == e["h"], F.lit(False))
            at = F.sort_array(F.transform(F.filter(s, lambda e, i: near(e, i, -1) | near(e, i, 1)), lambda e: e["p"]))
            first = F.struct(F.lit(0).alias("c"), F.lit(-n).alias("last"))
            return F.aggregate(at, first, lambda a, p: F.struct((a["c"] + F.least(F.lit(n), p - a["last"])).alias("c"), p.alias("last")), lambda a: a["c"])

        return let(pairs, union)

    def windows(wh: Column) -> Column:
        h = F.transform(F.sequence(F.lit(0), F.size(wh) - n), lambda i: F.xxhash64(*[F.get(wh, i + k) for k in range(n)]))
        return F.when(F.size(wh) < n, 0).otherwise(let(h, lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), 0).otherwise(covered(x))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), windows).cast("long")


def base_figures(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (names after ``prefix``).

    Columns of ``docs`` of these names get an underscore behind them.
    """
    p = prefix
    kept = apart(docs.columns, tuple(p + c for c in (*BASE, "n_lines")))
    docs = docs.select(*[docs[c].alias(k) for c, k in zip(docs.columns, kept)], docs[text_col].alias("qr_raw"))
    raw = F.coalesce(F.col("qr_raw"), F.lit(""))
    df = docs.withColumn("qr_words", let(F.btrim(raw, F.lit(" \t\n\x0b\f\r")), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE))))
    df = df.withColumn("qr_lines", F.filter(F.split(raw, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    long = lambda c: c.cast("long")
    return df.withColumns(
        {
            f"{p}n_words": long(F.size("qr_words")),
            f"{p}word_chars": long(F.length(F.translate(raw, " \t\n\x0b\f\r", ""))),
            f"{p}n_symbols": long(F.regexp_count(raw, F.lit(r"[#*$%&|<>]"))),
            f"{p}n_lines": long(F.size("qr_lines")),
            f"{p}n_dup_lines": long(F.size("qr_lines") - F.size(F.array_distinct("qr_lines"))),
            f"{p}n_repeat_words": repeated_words(F.col("qr_words")),
        }
    ).drop("qr_words", "qr_lines", "qr_raw")


def bin_of(v: Column, bits: int = 6) -> Column:
    """Sketch bin of a count: exact below 2**(bits+1), then 2**bits bins a power of two."""
    shift = F.greatest(F.lit(0), F.length(F.bin(v)) - (bits + 1))
    return shift.cast("long") * 2**bits + F.call_function("shiftright", v, shift)


def bin_low(b: str, bits: int = 6) -> str:
    """SQL for the least count that falls into bin ``b``."""
    n = 2**bits
    return f"CASE WHEN {b} < {2 * n} THEN {b} ELSE shiftleft({b} % {n} + {n}, CAST({b} div {n} - 1 AS INT)) END"


def fences(figures: DataFrame, keys: tuple[str, str], min_rows: int = 50, factor: float = 6.0) -> DataFrame:
    """(keys, low and high fence of each ratio) from ``figures`` with those two columns.

    A fence is the quartile plus or minus ``factor`` times the quartile distance or a slack,
    whichever is more. Groups under ``min_rows`` rows take their language's quartiles, and languages
    under that the quartiles of all rows.
    """
    lang, source = keys
    ratios = F.array(*[F.struct(F.lit(k).alias("k"), bin_of(F.expr(f"{num} * {scale} div greatest({den}, 1)")).alias("b")) for k, (_, num, den, scale, _, _) in enumerate(RATIOS)])
    bins = figures.where("n_words > 0").select(lang, source, F.inline(ratios)).groupBy(lang, source, "k", "b").agg(F.count("*").alias("n"))
    bins = written(bins, "quality-sketches")
    levels = []
    for level, by in enumerate(([lang, source], [lang], [])):
        merged = bins.groupBy(*by, "k", "b").agg(F.sum("n").alias("n"))
        own = Window.partitionBy(*by, "k")
        merged = merged.withColumns({"upto": F.sum("n").over(own.orderBy("b")), "all": F.sum("n").over(own)})
        q = lambda p: F.min(F.when(F.col("upto") * 4 >= F.col("all") * p, F.col("b")))
        quart = merged.groupBy(*by, "k").agg(q(1).alias("q1"), q(3).alias("q3"), F.first("all").alias("all"))
        levels.append(quart.groupBy(*by).agg(F.max("all").alias(f"n{level}"), *[F.max(F.when(F.col("k") == k, F.struct("q1", "q3"))).alias(f"m{level}_{k}") for k in range(len(RATIOS))]))
    groups = levels[0].join(levels[1], [lang]).join(F.broadcast(levels[2]), F.lit(True))  # the last is one row
    cols = [lang, source]
    for k, (name, _, _, _, slack, both) in enumerate(RATIOS):
        use = F.when(F.col("n0") >= min_rows, F.col(f"m0_{k}")).when(F.col("n1") >= min_rows, F.col(f"m1_{k}")).otherwise(F.col(f"m2_{k}"))
        groups = groups.withColumn(f"m_{k}", use)
        low, high = bin_low(f"m_{k}.q1"), bin_low(f"m_{k}.q3")
        width = f"greatest({factor:g}D * (({high}) - ({low})), {slack:g}D)"
        cols.append(F.expr(f"({high}) + {width}").alias(f"{name}_high"))
        if both:
            cols.append(F.expr(f"({low}) - {width}").alias(f"{name}_low"))
    return groups.select(*cols)


def judge(docs: DataFrame, carry: list[str], text_col: str = "text", lang_col: str = "lang", source_col: str = "source", broadcast_bytes: int = 32 << 20, salts: int = 16) -> DataFrame:
    """``carry`` columns, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, kept.

    base_failed: under 10 words, or over a fifth of them in repeated 5-word windows. kept: not
    base_failed, and each ratio within the fences of the row's language and source; null is a
    language or source of its own. Null and empty texts have no words and fail. Every row gives one
    row, repeated ids included. The text is read once: figures and ``carry`` are written to the
    shared folder, and sketches and verdicts come from there. The table of fences has a row for each
    pair of language and source; it is broadcast where it takes at most ``broadcast_bytes``, else
    joined by key with the rows of each key in ``salts`` parts. Carried columns of a result's name get
    an underscore behind them. An empty table gives no rows.
    """
    key = lambda c: F.when(docs[c].isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), docs[c].cast("string")))
    held = docs.select(*[docs[c].alias(f"qr_c{i}") for i, c in enumerate(carry)], key(lang_col).alias("qr_lang"), key(source_col).alias("qr_source"), docs[text_col].alias("qr_text"))
    figures = written(base_figures(held, "qr_text").drop("qr_text"), "quality-figures")
    limits = written(fences(figures, ("qr_lang", "qr_source")), "quality-fences")
    small = if_small(limits, broadcast_bytes)
    if small is not limits:
        rows = figures.join(small, ["qr_lang", "qr_source"], "left")
    else:
        salted = limits.withColumn("qr_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        rows = figures.withColumn("qr_salt", F.pmod(F.xxhash64("n_words", "word_chars", "n_lines"), F.lit(salts)).cast("int")).join(salted, ["qr_lang", "qr_source", "qr_salt"], "left")
    failed = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
    ok = []
    for name, num, den, scale, _, both in RATIOS:
        ratio = f"({num} * {scale} div greatest({den}, 1))"
        ok.append(f"{ratio} <= {name}_high" + f" AND {ratio} >= {name}_low" * both)
    rows = rows.withColumns({"base_failed": F.expr(failed), "kept": F.expr(f"NOT ({failed}) AND coalesce({' AND '.join(ok)}, false)")})
    named = apart(carry, (*BASE, "n_lines", "base_failed", "kept"))
    return rows.select(*[F.col(f"qr_c{i}").alias(c) for i, c in enumerate(named)], *BASE, "n_lines", "base_failed", "kept")


def query(spark, sf_dir) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", *BASE, "base_failed", "kept")


def stage(spark, docs: DataFrame, sf_dir: str, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Documents that the rules keep.

    The verdicts are a small table; the rows that go are joined away by id, text, language and
    source, broadcast where they take at most ``broadcast_bytes``.
    """
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    keyed = docs.select(*cols).withColumn("tkey", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    keys = ["doc_id", "tkey", "lang", "source"]
    with scope(spark):
        gone = written(judge(keyed, keys).where("NOT kept").select(*[F.col(k).alias(f"g_{k}") for k in keys]).distinct(), "quality-gone", keep=True)
    same = [keyed[k].eqNullSafe(gone[f"g_{k}"]) for k in keys]
    return keyed.join(if_small(gone, broadcast_bytes), functools.reduce(Column.__and__, same), "left_anti").select(*cols)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('0' || lang, '1') AS lang, coalesce('0' || source, '1') AS src, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, lang, src, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
u AS (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i+1], words[i+2], words[i+3], words[i+4]) AS n FROM u),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM g WHERE n > 1) GROUP BY rid),
f AS (SELECT w.rid, doc_id, lang, src, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN r ON w.rid = r.rid),
m AS (SELECT *, [word_chars * 100 // greatest(n_words, 1), n_symbols * 1000 // greatest(n_words, 1), n_dup_lines * 1000 // greatest(n_lines, 1), n_repeat_words * 1000 // greatest(n_words, 1)] AS v FROM f),
e AS (SELECT lang, src, k, v[k] AS v, greatest(0, length(ltrim(bin(v[k]), '0')) - 7) AS s FROM m, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE n_words > 0),
b AS (SELECT lang, src, k, s * 64 + (v >> s) AS b FROM e),
l AS (
  SELECT lang, src, k, b, count(*) OVER (PARTITION BY lang, src, k) AS n0, count(*) OVER (PARTITION BY lang, src, k ORDER BY b) AS u0,
         count(*) OVER (PARTITION BY lang, k) AS n1, count(*) OVER (PARTITION BY lang, k ORDER BY b) AS u1,
         count(*) OVER (PARTITION BY k) AS n2, count(*) OVER (PARTITION BY k ORDER BY b) AS u2 FROM b),
q2 AS (SELECT k, min(b) FILTER (u2 * 4 >= n2) AS a, min(b) FILTER (u2 * 4 >= n2 * 3) AS c FROM l GROUP BY k),
q1 AS (SELECT lang, k, any_value(n1) AS n, min(b) FILTER (u1 * 4 >= n1) AS a, min(b) FILTER (u1 * 4 >= n1 * 3) AS c FROM l GROUP BY lang, k),
q0 AS (SELECT lang, src, k, any_value(n0) AS n, min(b) FILTER (u0 * 4 >= n0) AS a, min(b) FILTER (u0 * 4 >= n0 * 3) AS c FROM l GROUP BY lang, src, k),
q AS (SELECT q0.lang, src, q0.k, CASE WHEN q0.n >= 50 THEN q0.a WHEN q1.n >= 50 THEN q1.a ELSE q2.a END AS a, CASE WHEN q0.n >= 50 THEN q0.c WHEN q1.n >= 50 THEN q1.c ELSE q2.c END AS c
      FROM q0 JOIN q1 ON q0.lang = q1.lang AND q0.k = q1.k JOIN q2 ON q0.k = q2.k),
y AS (SELECT lang, src, k, CASE WHEN a < 128 THEN a ELSE (a % 64 + 64) << CAST(a // 64 - 1 AS INT) END AS a, CASE WHEN c < 128 THEN c ELSE (c % 64 + 64) << CAST(c // 64 - 1 AS INT) END AS c FROM q),
z AS (SELECT lang, src, max(c + greatest(6 * (c - a), 60)) FILTER (k = 1) AS h1, max(a - greatest(6 * (c - a), 60)) FILTER (k = 1) AS l1,
             max(c + greatest(6 * (c - a), 100)) FILTER (k = 2) AS h2, max(c + greatest(6 * (c - a), 350)) FILTER (k = 3) AS h3, max(c + greatest(6 * (c - a), 180)) FILTER (k = 4) AS h4
      FROM y GROUP BY lang, src)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND coalesce(v[1] <= h1 AND v[1] >= l1 AND v[2] <= h2 AND v[3] <= h3 AND v[4] <= h4, false) AS kept
FROM m LEFT JOIN z ON m.lang = z.lang AND m.src = z.src
"""
