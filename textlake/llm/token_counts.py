"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as one symbol a byte in a doubly linked list. A heap holds the adjacent pairs that
have a rank; the lowest (rank, place) is popped again and again, stale ones are passed over, and
each merge unlinks a symbol and pushes the two new pairs. The count is the initial symbols minus
the merges; ids are never looked up. Splitting and normalizing follow the vocabulary file's own
settings, which ``Vocabulary`` reads and checks.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .scratch import apart, table

#: Words kept with their counts by one Python worker, and the longest of them in characters.
CACHED_WORDS, CACHED_CHARS = 600_000, 40


def small_batches(spark: SparkSession, rows: int = 500, size: int = 4 << 20) -> None:
    """Arrow batches of at most ``rows`` rows and about ``size`` bytes, as texts may be long. Session settings, which are never raised."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = int(spark.conf.get(name).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(name, most)


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in prints:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class Vocabulary(dict):
    """Counts of words by word; a missing word is counted, and kept while there is room."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, kinds = spec["model"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or model["unk_token"] or model["byte_fallback"]:
            raise ValueError(f"{path}: not a lower-casing word BPE")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if not split["invert"] or split["behavior"] != "Removed":
            raise ValueError(f"{path}: its split keeps what the pattern leaves out")
        space = r"\p{White_Space}"
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\s", space))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.hint = next((s[:2] for s in special if all(x.startswith(s[:2]) for x in special)), "")
        self.end = model["end_of_word_suffix"] or ""
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.chars = byte_chars()

    def __missing__(self, word: str) -> int:
        n = self.merge(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = n
        return n

    def merge(self, word: str) -> int:
        symbols = [self.chars[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.end
        n, ranks = len(symbols), self.ranks
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), n
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue  # one of the two was merged meanwhile
            symbols[i], symbols[j] = a + b, ""
            after[i] = k = after[j]
            alive -= 1
            if k < n:
                before[k] = i
                if (r := ranks.get((a + b, symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, a + b, symbols[k]))
            if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], a + b))) is not None:
                heapq.heappush(heap, (r, h, symbols[h], a + b))
        return alive

    def count(self, text: str | None) -> int:
        """Tokens of a text; each special string in it is one token."""
        if not text:
            return 0
        if self.special and self.hint in text:
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self.plain(p) for p in parts)
        return self.plain(text)

    def plain(self, text: str) -> int:
        if not text.isascii():
            # lower-casing goes character by character, so a capital sigma never becomes a final one
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return sum(map(self.__getitem__, self.pieces.findall(text.lower())))


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def token_count(text: Column, path: str) -> Column:
    """Tokens of ``text`` under the vocabulary file at ``path``, which every executor can open; null and empty: 0."""

    @F.pandas_udf("long")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(path)
        for texts in batches:
            yield texts.map(v.count).astype("int64")

    return counts(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit; one row for each row, repeated ones included.

    Columns of ``docs`` of these names get an underscore behind them. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    kept = apart(docs.columns, ("n_bytes", "n_tokens", "over_limit"))
    size = F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long")
    df = docs.select(*[docs[c].alias(k) for c, k in zip(docs.columns, kept)], size.alias("n_bytes"), token_count(docs[text_col], path).alias("n_tokens"))
    return df.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
