"""Benchmark decontamination by pigeonhole edit matching.

Text and items are lower-cased and every run of other characters than letters and digits becomes a
space; a space goes before and behind. An item of m characters may differ by k = floor(rate * m)
edits, the spaces around it counted, so an item under 1 / rate characters has to occur exactly and
as whole words. Cut into k + 1 pieces, one piece of any match is untouched. One automaton finds every
piece in a text; each hit names the place where the item would lie, and Myers' bit-parallel search
measures the edits there.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .scratch import apart, table, written
from .token_counts import small_batches

OTHER = re.compile(r"[\W_]+")
PAIRS = "array<struct<item_id:long,distance:int,item_chars:int>>"


def normal(text: str | None) -> str:
    """``text`` in words of letters and digits, one space before, between and behind them; empty if it has none."""
    words = OTHER.sub(" ", text.lower()).strip() if text else ""
    return f" {words} " if words else ""


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def pieces(item: str, k: int, at: int = 0, above: tuple = ()) -> list[tuple[int, str, tuple]]:
    """``item`` in k + 1 pieces: (place, piece, what must hold around it, innermost first).

    Halves share k - 1 edits, so in a match one half keeps to its share, and so on down to a piece
    without any. What holds a piece, up to the whole item, is (place, characters, masks, edits).
    """
    if not k:
        return [(at, item, above)]
    left = (k - 1) // 2
    cut = len(item) * (left + 1) // (k + 1)
    above = ((at, item, masks_of(item), k), *above)
    return pieces(item[:cut], left, at, above) + pieces(item[cut:], k - 1 - left, at + cut, above)


def nearest(item: str, masks: dict[str, int], text: str, k: int) -> int:
    """Least edits from ``item`` to any substring of ``text``, or k + 1 if more than k (Myers 1999)."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, left = full, 0, m, min(m, k + 1), len(text)
    for c in text:
        left -= 1
        eq = masks.get(c, 0)
        d0 = (((eq & up) + up) ^ up) | eq | down
        hp = down | (full & ~(d0 | up))
        hn = up & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
            if score < best:
                best = score
                if not best:
                    break
        if score - left > k and best > k:
            break
        hp = (hp << 1) & full
        hn = (hn << 1) & full
        up = hn | (full & ~(d0 | hp))
        down = d0 & hp
    return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.automaton, places = [], ahocorasick.Automaton(), {}
        for ident, raw in items:
            if item := normal(raw):
                k = int(rate * (len(item) - 2))
                for at, piece, above in pieces(item, k):
                    places.setdefault(piece, []).append((len(self.items), at, above))
                self.items.append((ident, item, k))
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def find(self, raw: str | None) -> list[tuple[int, int, int]]:
        """(item, edits, characters of the item) of each item that the text holds within its budget."""
        text = normal(raw)
        best: dict[int, int] = {}
        if not text or not self.items:
            return []
        for end, (size, found) in self.automaton.iter(text):
            start = end + 1 - size
            for i, at, above in found:
                if best.get(i) == 0:
                    continue
                if text.startswith(self.items[i][1], max(0, start - at)):
                    best[i] = 0
                    continue
                n = 0
                for a, part, masks, k in above:
                    low = start - at + a
                    n = nearest(part, masks, text[max(0, low - k) : max(0, low + len(part) + k)], k)
                    if n > k:
                        break
                else:
                    if above:
                        best[i] = min(n, best.get(i, n))
        return [(self.items[i][0], n, len(self.items[i][1]) - 2) for i, n in best.items()]


class Block:
    """Items that one worker searches for at a time; the matcher is built once a worker and kept while the block is."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.rate = items, rate

    @functools.cached_property
    def matcher(self) -> Matcher:
        return Matcher(self.items, self.rate)


def finder(held):
    """A pandas UDF that finds the items of the broadcast ``Block``."""

    @F.pandas_udf(PAIRS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = held.value.matcher
        for texts in batches:
            yield pd.Series([[{"item_id": i, "distance": d, "item_chars": m} for i, d, m in matcher.find(t)] for t in texts], dtype=object)

    return found


def finders(spark: SparkSession, items: DataFrame, rate: float = 0.1, block_bytes: int = 1 << 20, item_id: str = "item_id", item_text: str = "text") -> Iterator:
    """For each block of ``items`` a function of a text column: array of (item_id, distance, item_chars) that the text holds.

    Items are a stated query set that meets every document. Their bytes are summed first, and they
    are dealt by hash to blocks of about ``block_bytes``; the driver holds a block at a time, and so
    does a worker, since callers give each block a scan of its own. Null texts and texts without
    letters or digits hold nothing, and such items are nowhere; repeated items are one. No items give
    no blocks.
    """
    small_batches(spark)
    items = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where("t IS NOT NULL").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("b")).first().b
    n = -(-total // block_bytes)
    for block in range(n):
        rows = [tuple(r) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == block).orderBy("i", "t").collect()]
        yield finder(spark.sparkContext.broadcast(Block(rows, rate)))


def leaks(docs: DataFrame, items: DataFrame, carry: list[str], rate: float = 0.1, text_col: str = "text", item_id: str = "item_id", **names) -> DataFrame:
    """``carry`` columns, item_id, distance, item_chars: one row for each row of ``docs`` and item with an id found in it.

    A carried column that has a result's name gets an underscore behind it. Each block of items
    scans the documents anew; of most benchmarks there is one. Items of equal id and different text
    give a row each.
    """
    rows = docs.select(*[docs[c].alias(f"dc_{i}") for i, c in enumerate(carry)], docs[text_col].alias("dc_text"))
    named = [F.col(f"dc_{i}").alias(c) for i, c in enumerate(apart(carry, ("item_id", "distance", "item_chars")))]
    found = [
        rows.withColumn("dc_hits", find("dc_text")).select(*named, F.inline("dc_hits"))
        for find in finders(docs.sparkSession, items.where(F.col(item_id).isNotNull()), rate, item_id=item_id, **names)
    ]
    return functools.reduce(DataFrame.unionAll, found) if found else rows.where("false").select(*named, F.inline(F.lit(None).cast(PAIRS)))


def query(spark, sf_dir) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


def stage(spark, docs: DataFrame, sf_dir: str, **names) -> DataFrame:
    """Documents that hold no benchmark item, whether it has an id or not.

    Of several blocks, each searches what the one before left, which is written in between.
    """
    left = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for k, find in enumerate(finders(spark, table(spark, sf_dir, "benchmark"), **names)):
        left = (written(left, "clean") if k else left).where(F.size(find("text")) == 0)
    return left
