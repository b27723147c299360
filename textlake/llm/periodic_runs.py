"""Periodic runs of words by a harmonic grid.

For each period p the grid's places are the multiples of p. Two neighbouring places jp and (j+1)p of a
stretch of period p agree for some words forwards and for some backwards, and these two longest common
extensions (LCE) give the stretch's ends. A stretch of three periods or more holds such a pair, so the
grid finds each, with harmonically many queries in all. Forward LCEs are range minima (RMQ) over the
LCP array of the words' suffix array, backward ones over that of the reversed array. Suffix arrays are
built by prefix doubling in numpy; its ranks also give the LCP array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .scratch import apart, table
from .token_counts import small_batches

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Pairs of grid places that are looked at together.
GRID_ROWS = 1 << 18


def ranked(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the words from each place on, 1, 2, 4, ... of them, until all differ; -1 behind the last place."""
    n, levels, h = len(ids), [], 1
    found, rank = np.unique(ids, return_inverse=True)
    while True:
        levels.append(np.append(rank, -1).astype(np.int32))
        if len(found) == n:
            return levels
        key = rank.astype(np.int64) * (n + 1)
        key[: n - h] += rank[h:] + 1
        found, rank = np.unique(key, return_inverse=True)
        h *= 2


class Extensions:
    """LCE queries on ``ids``: suffix array, LCP array and minima of its spans of powers of two."""

    def __init__(self, levels: list[np.ndarray]):
        self.rank = levels[-1][:-1]
        n = len(self.rank)
        places = np.empty(n, np.int32)
        places[self.rank] = np.arange(n, dtype=np.int32)
        a, b = places[:-1].copy(), places[1:].copy()
        for k in range(len(levels) - 2, -1, -1):
            step = np.where(levels[k][a] == levels[k][b], np.int32(1 << k), np.int32(0))
            a += step
            b += step
        self.minima = [a - places[:-1]]
        self.longest = int(self.minima[0].max(initial=0))
        while 2 << (k := len(self.minima) - 1) <= n - 1:
            self.minima.append(np.minimum(self.minima[k][: -(1 << k)], self.minima[k][1 << k :]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``i`` and ``j``, different places, have in common."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        out = np.empty(len(a), np.int64)
        power = np.frexp(b - a)[1] - 1
        for k in np.unique(power):
            at = power == k
            out[at] = np.minimum(self.minima[k][a[at]], self.minima[k][b[at] - (1 << int(k))])
        return out


def runs(ids: np.ndarray) -> np.ndarray:
    """Start, length and smallest period of each run, a row a run, by start and period.

    A run is a stretch whose words one period apart are the same, which no neighbour extends, of at
    least LEAST_WORDS words and LEAST_PERIODS periods. Memory: about 12 bytes a word and power of two
    below the number of words, 250 MB for a million words.
    """
    n, none = len(ids), np.empty((0, 3), np.int64)
    if n < LEAST_WORDS:
        return none
    # a run of period p has two places that share max(24 - p, 2p) words, 16 at least
    levels = ranked(ids)
    shared = min(max(LEAST_WORDS - p, (LEAST_PERIODS - 1) * p) for p in range(1, LEAST_WORDS))
    if 1 << len(levels) - 1 <= shared:
        return none
    ahead = Extensions(levels)
    del levels
    low, high = max(1, LEAST_WORDS - ahead.longest), min(n // LEAST_PERIODS, ahead.longest // (LEAST_PERIODS - 1))
    if low > high:
        return none
    back = Extensions(ranked(ids[::-1]))
    periods = np.arange(low, high + 1, dtype=np.int64)
    pairs = (n - 1) // periods
    ends, found, at = np.cumsum(pairs), [], 0
    while at < len(periods):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GRID_ROWS, "right")))
        p, counts = np.repeat(periods[at:to], pairs[at:to]), pairs[at:to]
        i = (np.arange(len(p)) - np.repeat(np.cumsum(counts) - counts, counts)) * p
        same = ids[i] == ids[i + p]  # elsewhere the forward LCE is none, and a run has a pair where it isn't
        i, p = i[same], p[same]
        forward, backward = ahead(i, i + p), np.zeros(len(i), np.int64)
        inner = i > 0
        backward[inner] = back(n - i[inner], n - i[inner] - p[inner])
        length = p + forward + backward
        long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
        found.append(np.unique(np.stack([(i - backward)[long], length[long], p[long]], 1), axis=0))
        at = to
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):  # the same stretch at a multiple of its period
        rows = rows[np.append(True, (np.diff(rows[:, :2], axis=0) != 0).any(1))]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept(n: int, rows: np.ndarray) -> np.ndarray:
    """Which of ``n`` words no run has behind its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, rows[:, 0] + rows[:, 2], 1)
    np.add.at(edges, rows[:, 0] + rows[:, 1], -1)
    return np.cumsum(edges[:-1]) == 0


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with runs (start, length and period of each, in words, by start and period) and collapsed (words of no run's later periods, joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no runs and an empty collapsed text. A row
    for each row, repeated ones included; an empty table gives none. Texts are taken whole: see
    ``runs`` for the memory of a very long one. Columns of ``docs`` of these names get an underscore.
    """
    small_batches(docs.sparkSession)
    names = apart(docs.columns, ("runs", "collapsed"))
    raw = apart([text_col], tuple([*names, "runs", "collapsed"]))[0]
    rows = docs.select(*[docs[c].alias(k) for c, k in zip(docs.columns, names)], F.coalesce(docs[text_col], F.lit("")).cast("binary").alias(raw))
    made = {"runs": "array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed": "string"}
    schema = docs.sparkSession.createDataFrame([], rows.drop(raw).schema).withColumns({k: F.lit(None).cast(v) for k, v in made.items()}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_runs, texts = [], []
            for text in b[raw].to_pylist():
                words, number = text.split(), {}  # of byte strings: at these six characters
                ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
                r = runs(ids)
                all_runs.append(r)
                texts.append(b" ".join(words if not len(r) else [w for w, k in zip(words, kept(len(ids), r).tolist()) if k]))
            flat = np.concatenate([np.empty((0, 3), np.int64), *all_runs])
            ends = np.cumsum([0, *map(len, all_runs)], dtype=np.int32)
            items = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], ["start", "length", "period"])
            columns = [b[k] for k in names] + [pa.ListArray.from_arrays(pa.array(ends), items), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *made])

    return rows.mapInArrow(run, schema)


def damaged(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``documents``, a tenth of them (by crc32 of the id) with their tail replaced by repetitions of its first words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.coalesce(h % 10 == 0, F.lit(False)).alias("hit"))
    rows = rows.select("*", F.when(F.col("hit"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).alias("words"))
    rows = rows.select("*", F.size("words").cast("long").alias("n"))
    rows = rows.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    rows = rows.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    tail = "slice(flatten(array_repeat(slice(words, CAST(a + 1 AS INT), CAST(p AS INT)), CAST((n - a + p - 1) div p AS INT))), 1, CAST(n - a AS INT))"
    text = F.when(F.col("hit") & (F.col("n") > 0), F.expr(f"concat_ws(' ', slice(words, 1, CAST(a AS INT)), {tail})")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The runs' number, the one with most periods (ties: first start, then period) and digests of runs and collapsed texts."""
    run = "struct<start:bigint,length:bigint,period:bigint>"
    more = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    line = lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    rows = found.select("doc_id", "runs", "collapsed", F.aggregate("runs", F.lit(None).cast(run), more).alias("best"))
    exponent: Column = F.expr("1000 * best.length div best.period")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        exponent.alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find_runs(damaged(table(spark, sf_dir, "documents"))))
