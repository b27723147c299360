"""SentencePiece encoding and decoding for merge-type vocabularies, by a score-ordered agenda.

A text gets a space in front and splits where no piece can cross: before a space that follows another
character, after Latin letters and around line ends (the file is checked for that). Each chunk starts as one symbol a character. The agenda is a heap of
the adjacent pairs that join to a piece; the best score (ties: the leftmost) is popped again and
again, stale pairs are passed over, and each merge pushes the two pairs that it makes. A symbol is its
place and end in the chunk, so that what a pair joins to is one slice to look up. Characters that
no piece has are encoded by their bytes. Every chunk that a worker meets for the first time is encoded
by the sentencepiece library too, an Arrow batch's new chunks at a time, and any difference is an error.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import itertools
import re
import struct
import sys
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .scratch import apart, table
from .token_counts import small_batches

#: Chunks kept with their ids by one Python worker, in two generations, and the longest of them in characters.
CACHED_CHUNKS, CACHED_CHARS = 1_000_000, 40
#: The vocabulary's sign for a space (a fixed value of the format).
SPACE = "▁"
#: Kinds of pieces and fields of the model file's messages (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Bits of an agenda entry that hold the place, in chunks that fit the first and in longer ones. Entries of the first kind are small integers.
PLACE_BITS = (14, 30)

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


def fields(message: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """Number and value of each field of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = message[at]
            at, value, shift = at + 1, value | (b & 127) << shift, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(message):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = message[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = struct.unpack("<f" if size == 4 else "<d", message[at : at + size])[0], at + size
        yield key >> 3, value


class Pieces(dict):
    """Ids (int32 as bytes) of chunks by chunk; a missing chunk comes from the older generation or is encoded."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as f:
            model = list(fields(f.read()))
        trainer, norm = ({k: v for n, m in model if n == number for k, v in fields(m)} for number in (2, 3))
        pieces = [{1: b"", 2: 0.0, 3: NORMAL} | dict(fields(m)) for n, m in model if n == 1]
        if trainer.get(3) != BPE or not trainer.get(35) or trainer.get(24):
            raise ValueError(f"{path}: not a merge-type vocabulary with bytes for unknown characters")
        if norm.get(2) or norm.get(4, 1) or not norm.get(3, 1) or not norm.get(5, 1):
            raise ValueError(f"{path}: its normalizer does more than put a space in front")
        if {p[3] for p in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: has pieces of the user's or unused ones")
        self.path, self.fresh, self.older = path, [], {}
        names = [p[1].decode() for p in pieces]
        words = {n.replace(SPACE, " "): i for i, (n, p) in enumerate(zip(names, pieces)) if p[3] == NORMAL}
        self.alone = {w: i for w, i in words.items() if len(w) == 1}
        #: By kind of chunk: the rank of each longer piece's score, above the bits of a place.
        order = {score: k for k, score in enumerate(sorted({p[2] for p in pieces}, reverse=True))}
        self.ranks = [{w: order[pieces[i][2]] << bits for w, i in words.items() if len(w) > 1} for bits in PLACE_BITS]
        self.packed = {w: i.to_bytes(4, sys.byteorder) for w, i in words.items()}
        self.byte = {int(n[3:-1], 16): i for i, (n, p) in enumerate(zip(names, pieces)) if p[3] == BYTE}
        if " " not in words or any(len(w) > 1 and (" " in w.lstrip(" ") or "\n" in w or re.search(f"[{LETTERS}][^{LETTERS}]", w)) for w in words):
            raise ValueError(f"{path}: has pieces across the places where texts split")
        #: What each id reads as. A byte over 127 is a lone surrogate until its neighbours are known.
        self.reads = [n.replace(SPACE, " ") for n in names]
        for i, p in enumerate(pieces):
            if p[3] == CONTROL:
                self.reads[i] = ""
            elif p[3] == UNKNOWN:
                self.reads[i] = trainer.get(44, " ⁇ ".encode()).decode()
        for b, i in self.byte.items():
            self.reads[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        self.leading = {i for i, p in enumerate(pieces) if p[3] == NORMAL and self.reads[i].startswith(" ")}
        self.silent = {i for i, p in enumerate(pieces) if p[3] == CONTROL}

    def __missing__(self, chunk: str) -> bytes:
        if (ids := self.older.get(chunk)) is None:
            ids = self.agenda(chunk)
            self.fresh.append((chunk, ids))
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHED_CHUNKS // 2:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def agenda(self, chunk: str) -> bytes:
        """Ids of a chunk. The heap's entries are integers: rank and place of the left symbol, from high bits to low."""
        n = len(chunk)
        long = n >> PLACE_BITS[0] > 0
        rank, places = self.ranks[long].get, (1 << PLACE_BITS[long]) - 1
        #: The entry that holds for the pair at each place, -1 for none; others in the heap are stale.
        due = [-1 if (r := rank(c)) is None else r + i for i, c in enumerate(map(add, chunk, chunk[1:]))]
        heap = [e for e in due if e >= 0]
        heap.sort()
        due.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        while heap:
            top = heapq.heappop(heap)
            i = top & places
            if due[i] != top:
                continue  # one of the two was merged meanwhile
            j = after[i]
            after[i] = k = after[j]
            before[k] = i
            due[i] = due[j] = -1
            if k < n and (r := rank(chunk[i : after[k]])) is not None:
                due[i] = e = r + i
                heapq.heappush(heap, e)
            if i:
                h = before[i]
                if (r := rank(chunk[h:k])) is not None:
                    due[h] = e = r + h
                    heapq.heappush(heap, e)
                else:
                    due[h] = -1
        out, i = [], 0
        while i < n:
            j = after[i]
            if (ids := self.packed.get(chunk[i:j])) is not None:
                out.append(ids)
            else:
                out += [self.byte[b].to_bytes(4, sys.byteorder) for b in chunk[i:j].encode()]
            i = j
        return b"".join(out)

    #: Where a text splits: after letters, before spaces and around line ends.
    chunks = staticmethod(re.compile(rf" *[^ \n{LETTERS}]*[{LETTERS}]+| +[^ \n{LETTERS}]*|[^ \n{LETTERS}]+|\n").findall)

    def encode(self, text: str) -> bytes:
        """Ids of a text, int32 as bytes; none for an empty one. The vocabulary's space sign counts as a space."""
        return b"".join(map(self.__getitem__, self.chunks(f" {text}".replace(SPACE, " ")))) if text else b""

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the space in front goes, and each byte that is part of no character reads as U+FFFD."""
        reads = self.reads
        if not self.silent.isdisjoint(ids):  # a control piece reads as nothing, but bytes around it don't meet
            spans = [list(x) for silent, x in itertools.groupby(ids, self.silent.__contains__) if not silent]
            return self.decode(spans[0]) + "".join([self.decode([self.alone[" "], *x]) for x in spans[1:]]) if spans else ""
        out = "".join([reads[i] for i in ids])
        if len(ids) and ids[0] in self.leading:
            out = out[1:]
        return out if out.isascii() else out.encode("utf-8", "surrogateescape").decode("utf-8", "each-byte")

    def check(self) -> None:
        """Compares the chunks that were new since the last check with the library's ids of them; raises at a difference."""
        fresh, self.fresh = self.fresh, []
        # after a line end a chunk reads as it is, without the library's space in front
        front = np.array([self.alone[" "], self.byte[10]], np.int32).tobytes()
        theirs = library(self.path).encode([f"\n{c}" for c, _ in fresh], num_threads=1)
        ours = [front + ids for _, ids in fresh]
        if [4 * len(x) for x in theirs] != [*map(len, ours)] or np.fromiter(itertools.chain.from_iterable(theirs), np.int32).tobytes() != b"".join(ours):
            chunk = next(c for (c, _), x, y in zip(fresh, theirs, ours) if np.array(x, np.int32).tobytes() != y)
            raise ValueError(f"the agenda and the library differ on {chunk[:200]!r}")


@functools.lru_cache(maxsize=2)
def library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def lists(column: pa.ListArray) -> Iterator[list[int] | None]:
    """Each row's integers, None for null; a row becomes plain integers at once, without an Arrow scalar for each."""
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
    for a, b, there in zip(ends, ends[1:], column.is_valid().to_pylist()):
        yield values[a:b].tolist() if there else None


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ids (array of int) and n_tokens under the model file at ``path``, which every executor can open.

    Null and empty texts have no ids. A row for each row, repeated ones included; an empty table gives
    none. A very long text is encoded whole: a chunk needs about 200 bytes a character while it is
    merged, and a text without spaces and line ends is one chunk. Columns of ``docs`` named ids or
    n_tokens get an underscore behind them.
    """
    small_batches(docs.sparkSession)
    kept = apart(docs.columns, ("ids", "n_tokens"))
    text = apart([text_col], tuple([*kept, "ids", "n_tokens"]))[0]
    rows = docs.select(*[docs[c].alias(k) for c, k in zip(docs.columns, kept)], F.coalesce(docs[text_col], F.lit("")).alias(text))
    schema = docs.sparkSession.createDataFrame([], rows.drop(text).schema).withColumn("ids", F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for b in batches:
            made = [p.encode(t) for t in b[text].to_pylist()]
            p.check()
            ends = np.cumsum([0, *[len(x) // 4 for x in made]], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(made), np.int32)))
            yield pa.RecordBatch.from_arrays([b[k] for k in kept] + [ids], names=[*kept, "ids"])

    return rows.mapInArrow(run, schema).withColumn("n_tokens", F.size("ids").cast("long"))


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with decoded, the text of the ids in ``ids_col``; null for null, empty for none. An id that the model hasn't fails the job."""
    small_batches(rows.sparkSession)
    kept = apart(rows.columns, ("decoded",))
    ids = kept[rows.columns.index(ids_col)]
    rows = rows.toDF(*kept)
    schema = rows.sparkSession.createDataFrame([], rows.schema).withColumn("decoded", F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for b in batches:
            texts = [None if x is None else p.decode(x) for x in lists(b[ids])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*kept, "decoded"])

    return rows.mapInArrow(run, schema)


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of ids (decimal, joined by commas) and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("doc_id", "n_tokens", F.sha2(joined, 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(decode(encode(docs, path).drop("text"), path))
