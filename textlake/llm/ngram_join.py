"""N-gram Jaccard join: a grouped prefix join over sets of word shingles.

Documents with equal sets are one class. A class that has a link misses fewer of its shingles in the
other set than its prefix is long, so a class of which that many shingles occur in no other set has
no link and leaves: first by some shingles of each class (in a few small sizes one more has to be
alone, as the other class's looked-up part can be shorter), then by all shingles of those that are
left, among each other. Of the others, the prefix is the first shingles in one global order, frequent ones
last; two sets that are similar enough share a shingle of their prefixes. Classes with
identical prefix and size are one group; groups that share a prefix shingle are filtered by size,
place and parity sketch, expanded to classes, filtered by larger sketches, and verified on whole
sets. Where more than CROWD classes share a prefix shingle, a first, linear round over these links
neighbours in size; the main round then passes over pairs that are connected already, so a large
group of near copies costs no pair of each two.
"""

from __future__ import annotations

import collections
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from .components import components
from .scratch import if_small, scope, table, written
from .token_counts import small_batches

#: Documents that a frequency segment holds, and the least count in one for a shingle to be told of.
SEGMENT, LOCAL = 4096, 3
#: Shingles in more than one of so many documents are ordered by frequency; at most so many of them.
SHARE, HEAVY = 2000, 500_000
#: Classes that share a prefix shingle before the first round links neighbours among them, and rows that it looks back.
CROWD, BACK = 64, 32
#: Shingles looked up for ``lonely``, as a multiple of the prefix; of them each block and range has about so many.
LOOKED_UP, BLOCK_ENTRIES, RANGE_ENTRIES = 1.6, 1 << 19, 1 << 20
#: Bytes of the sketch that goes with each prefix shingle.
SKETCH = 64
#: Rows of a bucket that meet in one cell, and the share (one in so many) that also meet other cells' rows in the first round.
CELL, DELEGATES = 256, 16
#: Sides of rows in a cell: those of the two facing sides meet, and those without a side meet each other.
FACING, ALONE = (0, 1), 2


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of ``text``, A-Z lower-cased.

    Words are split at ASCII white space. Fewer words than ``n`` are one shingle, none give none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, 0x9E3779B97F4A7C15 ^ size, np.uint64)
    for i in range(size):
        h = (h + w[i : len(w) - size + 1 + i]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
    return np.unique(h)


def least_overlap(a, b, percent: int):
    """Least common shingles of sets of sizes ``a`` and ``b`` with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def looked_up(n, percent: int):
    """Length of ``ext`` of sets of ``n``."""
    return np.minimum(n, (LOOKED_UP * prefix_length(n, percent)).astype(np.int64) + 1)


@functools.lru_cache(1 << 16)
def least_alone(n: int, percent: int) -> int:
    """Shingles of ``ext`` of a set of ``n`` that have to be in no other ``ext`` for the set to have no link.

    A set of b that links misses at most b - o and n - o shingles, o the least overlap. The common
    shingles of both exts are the first in one order, so of x and y looked up at most
    max(n - o, x - y + b - o) of the x aren't among the y. For most sizes that is the prefix's length
    less one; in small sets rounding makes it more.
    """
    b = np.arange(-(-percent * n // 100), 100 * n // percent + 1)
    o = least_overlap(n, b, percent)
    most = np.maximum(n - o, looked_up(np.array(n), percent) - looked_up(b, percent) + b - o)
    return int(most[o <= np.minimum(n, b)].max()) + 1


def bitmap(s: np.ndarray) -> bytes:
    """Parity of the set's members by hash in 2n bits or more; bits that differ between two sets are members that differ."""
    bits = max(8 * SKETCH, 1 << int(2 * len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(a: bytes, size: int) -> bytes:
    while len(a) > size:
        half = len(a) // 2
        a = (int.from_bytes(a[:half], "little") ^ int.from_bytes(a[half:], "little")).to_bytes(half, "little")
    return a


def bits_apart(a: bytes, b: bytes) -> int:
    a, b = folded(a, len(b)), folded(b, len(a))
    return (int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_count()


def frequent(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles (sorted) and their ranks, rarer ones first, from counts over all documents.

    Segments of SEGMENT documents tell of shingles that LOCAL of their distinct sets hold; sums over
    segments are estimates from below. The shares of all shingles sum to the mean set size, so those
    above one in SHARE are SHARE times that at most; over HEAVY only the most frequent stay, which
    costs time and no links, as any order gives right results.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[bytes, np.ndarray] = {}

        def told() -> pa.RecordBatch:
            every, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets.values()]), return_counts=True)
            keep = times >= LOCAL
            return pa.RecordBatch.from_pydict({"h": pa.array(every[keep].view(np.int64)), "c": pa.array(times[keep].astype(np.int64)), "d": pa.nulls(int(keep.sum()), pa.int64())})

        docs_seen = held = 0
        for b in batches:
            for t in b["t"].to_pylist():
                s = shingles(t, n)
                docs_seen += 1
                if len(s):
                    sets[xxhash.xxh3_128_digest(s.tobytes())] = s
                    held += len(s)
                if len(sets) >= SEGMENT or held > 4_000_000:
                    yield told()
                    sets, held = {}, 0
        yield told()
        yield pa.RecordBatch.from_pydict({"h": pa.nulls(1, pa.int64()), "c": pa.array([0]), "d": pa.array([docs_seen])})

    counts = docs.select("t").mapInArrow(count, "h long, c long, d long").groupBy("h").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    counts = written(counts, "shingle-counts")
    total = counts.where("h IS NULL").agg(F.sum("d").alias("d")).first().d or 0
    top = counts.where(F.col("h").isNotNull() & (F.col("c") * SHARE >= total)).orderBy(F.desc("c"), "h").limit(HEAVY).select("h").toPandas()
    h = top["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], (len(h) - np.arange(len(h)))[order]


def prefix(s: np.ndarray, length: int, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """First ``length`` of the set: by hash the shingles that aren't frequent, then frequent ones by rank."""
    if not len(heavy):
        return s[:length]
    at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
    is_heavy = heavy[at] == s
    rare = s[~is_heavy][:length]
    if len(rare) == length:
        return rare
    common, places = s[is_heavy], at[is_heavy]
    return np.concatenate((rare, common[np.argsort(rank[places], kind="stable")][: length - len(rare)]))


def described(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, tkey, n, sig, gid, ext, bits) of ``docs`` (doc_id, tkey, t); sig is null for empty sets.

    ext is the prefix and what follows it in the order, LOOKED_UP times as long.
    """
    heavy, rank = frequent(docs, n)
    held = docs.sparkSession.sparkContext.broadcast((heavy, rank))
    types = pa.schema([("doc_id", pa.int64()), ("tkey", pa.binary()), ("n", pa.int64()), ("sig", pa.binary()), ("gid", pa.binary()), ("ext", pa.list_(pa.int64())), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b["t"].to_pylist():
                s = shingles(t, n)
                if not len(s):
                    rows.append((0, None, None, None, None))
                    continue
                k = prefix_length(len(s), percent)
                p = prefix(s, int(looked_up(np.array(len(s)), percent)), *held.value)
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), xxhash.xxh3_128_digest(p[:k].tobytes() + len(s).to_bytes(8, "little")), p.view(np.int64), bitmap(s)))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["tkey"], *(pa.array(list(c), t) for c, t in zip(cols, types.types[2:]))], schema=types)

    return docs.mapInArrow(run, "doc_id long, tkey binary, n long, sig binary, gid binary, ext array<long>, bits binary")


def lonely(classes: DataFrame, percent: int) -> DataFrame:
    """sig of the ``classes`` (sig, n, ext or all: s) that have no link, as enough of these shingles are in no other class's.

    Shingles go to ranges of their mixed hashes as packed arrays, six bytes each: 32 bits of the hash and
    the class's place in its block. What is equal in those bits counts as shared, so no class leaves
    wrongly. A range answers with the places of shingles that it saw once; a block adds them up. The
    number of ranges follows the number of shingles, so what a task holds doesn't.
    """
    whole = "s" in classes.columns
    size = F.octet_length("s") / 8 if whole else F.size("ext")
    total = classes.agg(F.coalesce(F.sum(size), F.lit(0)).alias("k")).first().k
    ranges = 1 << max(4, int(total // RANGE_ENTRIES).bit_length())
    shift = np.uint64(64 - (ranges.bit_length() - 1))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        sigs, need, tokens, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            h = np.concatenate(tokens) * np.uint64(0x9E3779B97F4A7C15)  # ext has the least hashes; mixed, they are in all ranges alike
            place = np.repeat(np.arange(len(tokens), dtype=np.uint16), [len(t) for t in tokens])
            r = (h >> shift).astype(np.int64)
            order = np.argsort(r, kind="stable")
            low, place, r = ((h >> (shift - np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)[order], place[order], r[order]
            at = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            name = part << 32 | count
            toks = [x.tobytes() for x in np.split(low, at[1:])] + [None]
            places = [x.tobytes() for x in np.split(place, at[1:])] + [None]
            none = [None] * len(at)
            return pa.RecordBatch.from_pydict({"rng": pa.array([*r[at], name % ranges], pa.int64()), "blk": pa.array([name] * (len(at) + 1), pa.int64()), "toks": pa.array(toks, pa.binary()), "places": pa.array(places, pa.binary()), "sigs": pa.array([*none, b"".join(sigs)], pa.binary()), "need": pa.array([*none, np.array(need, np.uint32).tobytes()], pa.binary())})

        for b in batches:
            for sig, n, x in zip(b["sig"].to_pylist(), b["n"].to_pylist(), b[2]):
                sigs.append(sig)
                need.append(prefix_length(n, percent) if whole else least_alone(n, percent))
                tokens.append(np.frombuffer(x.as_buffer(), np.uint64) if whole else x.values.to_numpy().view(np.uint64))
                held += len(tokens[-1])
                if len(sigs) == 65535 or held > BLOCK_ENTRIES:
                    yield block()
                    sigs, need, tokens, held, count = [], [], [], 0, count + 1
        if sigs:
            yield block()

    def once(t: pa.Table) -> pa.Table:
        blk, toks, places, sigs, need = (t[c].to_pylist() for c in ("blk", "toks", "places", "sigs", "need"))
        told = [i for i, x in enumerate(toks) if x is not None]
        rest = [i for i, x in enumerate(toks) if x is None]
        out = {"blk": [blk[i] for i in rest], "places": [None] * len(rest), "sigs": [sigs[i] for i in rest], "need": [need[i] for i in rest]}
        if told:
            each = [np.frombuffer(toks[i], np.uint32) for i in told]
            every = np.concatenate(each)
            order = np.argsort(every, kind="stable")
            new = np.concatenate(([True], every[order][1:] != every[order][:-1], [True]))
            single = np.empty(len(every), bool)
            single[order] = new[1:] & new[:-1]
            for i, mask in zip(told, np.split(single, np.cumsum([len(x) for x in each])[:-1])):
                out["blk"].append(blk[i])
                out["places"].append(np.frombuffer(places[i], np.uint16)[mask].tobytes())
                out["sigs"].append(None)
                out["need"].append(None)
        return pa.table({"blk": pa.array(out["blk"], pa.int64()), **{c: pa.array(out[c], pa.binary()) for c in ("places", "sigs", "need")}})

    def add(t: pa.Table) -> pa.Table:
        sigs, need = (next(x for x in t[c].to_pylist() if x is not None) for c in ("sigs", "need"))
        need = np.frombuffer(need, np.uint32)
        seen = np.zeros(len(need), np.int64)
        for x in t["places"].to_pylist():
            if x:
                seen += np.bincount(np.frombuffer(x, np.uint16), minlength=len(need))
        return pa.table({"sig": pa.array([sigs[16 * i : 16 * i + 16] for i in np.flatnonzero(seen >= need)], pa.binary())})

    packed = classes.select("sig", "n", "s" if whole else "ext").mapInArrow(pack, "rng long, blk long, toks binary, places binary, sigs binary, need binary")
    answered = packed.groupBy("rng").applyInArrow(once, "blk long, places binary, sigs binary, need binary")
    return answered.groupBy("blk").applyInArrow(add, "sig binary")


def bucket_pairs(percent: int, first_round: bool):
    """For rows (cell, side, gid, n, pos, root, sk) sorted by cell and n: candidate pairs of groups.

    First round: a row with the nearest two of the BACK rows before it whose sketches allow a link.
    Main round: all rows of a cell whose sides, sizes, places and sketches allow one, except those of
    one known component. A worker holds some cells at a time, and a cell has about 2 * CELL rows at most.
    """

    def emit(a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"ga": pa.array(a, pa.binary()), "gb": pa.array(b, pa.binary())})

    def linear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, back = None, collections.deque(maxlen=BACK)
        for b in batches:
            a, c = [], []
            for t, g, n, sk in zip(*(b[x].to_pylist() for x in ("cell", "gid", "n", "sk"))):
                sk, found = int.from_bytes(sk, "little"), 0
                if t != cell:
                    cell = t
                    back.clear()
                for g2, n2, sk2 in reversed(back):
                    if n2 * 100 < percent * n or found == 2:
                        break
                    if (sk ^ sk2).bit_count() <= n + n2 - 2 * least_overlap(n, n2, percent):
                        a.append(g2)
                        c.append(g)
                        found += 1
                back.append((g, n, sk))
            yield emit(a, c)

    def all_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, held = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            rest.append(b)
            held += b.num_rows
            if held < 20_000:
                continue
            whole = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
            cells = whole["cell"].to_numpy()
            last = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
            if last:
                yield from of(whole.slice(0, last))
            rest, held = [whole.slice(last)], whole.num_rows - last
        if rest:
            yield from of(pa.Table.from_batches(rest).combine_chunks().to_batches()[0])

    def of(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cell, side, n, pos, root = (rows[x].to_numpy(zero_copy_only=False) for x in ("cell", "side", "n", "pos", "root"))
        gid, blank = rows["gid"], bytes(SKETCH)
        sk = np.frombuffer(b"".join([x or blank for x in rows["sk"].to_pylist()]), np.uint64).reshape(len(cell), SKETCH // 8)
        many = ~rows["sk"].is_valid().to_numpy(zero_copy_only=False)  # groups of several classes have no sketch
        active, d = np.arange(1, len(cell)), 1
        while len(active):
            j = active - d
            go_on = (cell[j] == cell[active]) & (n[j] * 100 >= percent * n[active])
            i, j = active[go_on], j[go_on]
            need = least_overlap(n[i], n[j], percent)
            meet = (side[i] + side[j] == FACING[0] + FACING[1]) | (side[i] == ALONE) & (side[j] == ALONE)
            ok = meet & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= need) & ((root[i] != root[j]) | (root[i] == 0))
            at = np.flatnonzero(ok)
            apart = np.bitwise_count(sk[i[at]] ^ sk[j[at]]).sum(axis=1, dtype=np.int64)
            at = at[many[i[at]] | many[j[at]] | (apart <= n[i[at]] + n[j[at]] - 2 * need[at])]
            if len(at):
                yield emit(gid.take(pa.array(j[at])), gid.take(pa.array(i[at])))
            d += 1
            active = i[i >= d]

    return linear if first_round else all_pairs


def crowded(entries: DataFrame, over: int) -> DataFrame:
    """(token, k, main, m) of buckets over ``over`` rows: their rows, the component that most of these have, and rows that have it."""
    counts = entries.groupBy("token", "root").agg(F.count("*").alias("c"))
    largest = F.max(F.when(F.col("root") != 0, F.struct("c", "root")))
    sums = counts.groupBy("token").agg(F.sum("c").alias("k"), largest.alias("top")).where(F.col("k") > over)
    return sums.select("token", "k", F.coalesce("top.root", F.lit(0).cast("long")).alias("main"), F.coalesce("top.c", F.lit(0).cast("long")).alias("m"))


#: Cells of a crowded bucket's row in the first round: its own, and one with other cells' rows for one row in DELEGATES ** level.
LEVELS = f"""transform(filter(sequence(0, greatest(0, CAST(ceil(log({{d}}, k / {{c}})) AS INT))), l -> pmod(xxhash64(token, gid), CAST(power({{d}}, l) AS BIGINT)) = 0),
  l -> struct(xxhash64(token, l, pmod(xxhash64(gid, l), CAST(ceil(k / ({{c}} * power({{d}}, l))) AS BIGINT))) AS cell, {ALONE} AS side))"""
#: In the main round: rows of the main component in blocks against the others in blocks, and these blocks against each other.
GRID = f"""CASE WHEN root = main AND main <> 0 THEN CASE WHEN ko = 0 THEN array() ELSE transform(sequence(0, ko - 1), p -> struct(xxhash64(token, 0, p, pmod(h, km)) AS cell, {FACING[1]} AS side)) END
  ELSE concat(CASE WHEN km = 0 THEN array() ELSE transform(sequence(0, km - 1), q -> struct(xxhash64(token, 0, pmod(h, ko), q) AS cell, {FACING[0]} AS side)) END,
    transform(sequence(0, ko - 1), j -> struct(xxhash64(token, 1, least(pmod(h, ko), j), greatest(pmod(h, ko), j)) AS cell,
      CASE WHEN pmod(h, ko) = j THEN {ALONE} WHEN pmod(h, ko) < j THEN {FACING[0]} ELSE {FACING[1]} END AS side))) END"""


def dealt(entries: DataFrame, first_round: bool) -> DataFrame:
    """``entries`` (token, gid, n, pos, root, sk) in cells of bounded size: (cell, side, gid, n, pos, root, sk).

    The first round has buckets over CROWD rows only. They are dealt by hash to cells of about CELL
    rows, and ever fewer delegates of these meet at further levels, so near copies of one bucket
    still connect. In the main round a bucket of up to CELL rows is a cell; of a larger one every
    pair that isn't in the main component meets in one cell: blocks of the other rows meet blocks of
    the main component's, and each other. Cells that share a hash only make pairs that needn't be.
    """
    big = if_small(written(crowded(entries, CROWD if first_round else CELL), "crowded"))
    rows = entries.join(big, "token", "inner" if first_round else "left").withColumn("h", F.xxhash64("gid"))
    if first_round:
        cells = F.expr(LEVELS.format(d=DELEGATES, c=CELL))
    else:
        blocks = lambda c: F.ceil(c / CELL).cast("long")
        rows = rows.withColumns({"km": blocks(F.col("m")), "ko": blocks(F.col("k") - F.col("m"))})
        cells = F.expr(GRID)
    cells = F.when(F.col("k").isNull(), F.array(F.struct(F.col("token").alias("cell"), F.lit(ALONE).alias("side")))).otherwise(cells)
    return rows.select(F.inline(cells), "gid", "n", "pos", "root", "sk")


def group_pairs(groups: DataFrame, percent: int, first_round: bool) -> DataFrame:
    """Distinct candidate pairs (ga, gb) of ``groups`` (gid, n, root, prefix, sk)."""
    entries = groups.select("gid", "n", "root", "sk", F.posexplode("prefix").alias("pos", "token")).select("token", "gid", "n", F.col("pos").cast("long").alias("pos"), "root", "sk")
    rows = dealt(entries, first_round).repartition("cell").sortWithinPartitions("cell", "n", "gid")
    found = rows.mapInArrow(bucket_pairs(percent, first_round), "ga binary, gb binary")
    return found.select(F.least("ga", "gb").alias("ga"), F.greatest("ga", "gb").alias("gb")).distinct()


def whole_sets(classes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(sig, n, s) of ``classes``: all shingles, made again from one text of each."""
    wanted = written(classes.select(F.col("least").alias("w_id"), F.col("tkey").alias("w_key")).distinct(), "wanted")
    texts = docs.join(if_small(wanted), (docs["tkey"] == F.col("w_key")) & docs["doc_id"].eqNullSafe(F.col("w_id")), "left_semi").select("t")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            made = [shingles(t, n).tobytes() for t in r["t"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(x) for x in made], pa.binary()), pa.array([len(x) // 8 for x in made], pa.int64()), pa.array(made, pa.binary())], ["sig", "n", "s"])

    return written(texts.mapInArrow(sets, "sig binary, n long, s binary").groupBy("sig").agg(F.first("n").alias("n"), F.first("s").alias("s")), "sets")


def verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) among ``pairs`` (a, b: sig) of classes; pairs that the bitmaps rule out go before ``sets`` are read."""
    side = lambda x: classes.select(F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            cols = [r[x].to_pylist() for x in ("na", "nb", "bitsa", "bitsb")]
            keep = [bits_apart(x, y) <= a + b - 2 * least_overlap(a, b, percent) for a, b, x, y in zip(*cols)]
            yield pa.RecordBatch.from_arrays([r["a"], r["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = written(both.mapInArrow(sift, "a binary, b binary"), "pairs")
    wanted = left.select(F.col("a").alias("sig")).unionByName(left.select(F.col("b").alias("sig"))).distinct()
    one = sets.join(wanted, "sig", "left_semi")
    full = left.join(one.select(F.col("sig").alias("a"), F.col("s").alias("sa")), "a").join(one.select(F.col("sig").alias("b"), F.col("s").alias("sb")), "b")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            keep = []
            for x, y in zip(r["sa"].to_pylist(), r["sb"].to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([r["a"], r["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return written(full.select("a", "b", "sa", "sb").mapInArrow(test, "a binary, b binary"), "links")


@F.pandas_udf(T.BinaryType())
def sketch(bits: pd.Series) -> pd.Series:
    return bits.map(lambda b: folded(b, SKETCH))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tkey (md5 of the text), n_shingles, component_id of each row of ``docs``.

    Rows link where 100 * intersection >= percent * union of their shingle sets; component_id is the
    smallest id that links reach (null ids aren't smallest unless all are). Null, empty and blank
    texts have an empty set, link with nothing, and are their own component. Repeated rows give a row each.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.unhex(F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary"))).alias("tkey"), docs[text_col].alias("t"))
    with scope(docs.sparkSession):
        every = written(described(rows, n, percent), "shingle-sets")
        known = linked_classes(every, rows, n, percent)
        out = every.select("doc_id", "tkey", "n", "sig").join(known, "sig", "left")
        return written(out.select("doc_id", "tkey", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")), "near-copies", keep=True)


def linked_classes(every: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """(sig, component) of the classes of several rows or with a link; the others are their own component."""
    one = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("d"), F.col("tkey").alias("t")))
    classes = every.where("sig IS NOT NULL").groupBy("sig").agg(one.alias("one"), F.count("*").alias("members"), *[F.first(c).alias(c) for c in ("n", "gid", "ext", "bits")])
    every_class = written(classes.withColumns({"least": F.col("one.d"), "tkey": F.col("one.t")}).drop("one"), "shingle-classes")
    left = written(every_class.join(lonely(every_class, percent), "sig", "left_anti"), "shingle-suspects")
    sets = whole_sets(left, rows, n)
    left = written(left.join(lonely(sets, percent), "sig", "left_anti").withColumn("sk", sketch(F.col("bits"))), "shingle-suspects")
    classes = left.withColumn("prefix", F.slice("ext", F.lit(1), (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))).drop("ext")

    met = group_pairs(classes.select(F.col("sig").alias("gid"), "n", "prefix", "sk", F.lit(0).cast("long").alias("root")), percent, True)
    groups = classes.groupBy("gid").agg(F.min("sig").alias("rep"))
    within = classes.join(groups, "gid").where("sig <> rep").select(F.col("rep").alias("a"), F.col("sig").alias("b"))
    first = verified(met.select(F.col("ga").alias("a"), F.col("gb").alias("b")).unionByName(within).distinct(), classes, sets, percent)
    roots = written(components(first), "roots")
    rooted = written(classes.select("gid", "sig", "n", "prefix", "sk").join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig")), "rooted")
    one_root = F.when(F.min("root") == F.max("root"), F.xxhash64(F.min("root"))).otherwise(F.lit(0).cast("long"))
    groups = written(rooted.groupBy("gid").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.when(F.count("*") == 1, F.first("sk")).alias("sk"), one_root.alias("root")), "prefix-groups")
    met = group_pairs(groups, percent, False).unionByName(groups.where("root = 0").select(F.col("gid").alias("ga"), F.col("gid").alias("gb")))
    member = lambda x: rooted.select(F.col("gid").alias(f"g{x}"), F.col("sig").alias(x), F.col("root").alias(f"r{x}"))
    pairs = met.join(member("a"), "ga").join(member("b"), "gb").where("ra <> rb AND (ga <> gb OR a < b)").select("a", "b").distinct()
    second = verified(pairs, classes, sets, percent)
    roots = components(first.unionByName(second))
    linked = written(every_class.select("sig", "least", "members").join(roots.withColumnRenamed("node", "sig"), "sig", "left").where("root IS NOT NULL OR members > 1"), "near-linked")
    smallest = written(linked.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("component")), "near-smallest")
    return written(linked.join(if_small(smallest), "root", "left").select("sig", F.coalesce("component", "least").alias("component")), "near-components")


def query(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 90).select("doc_id", "n_shingles", "component_id")


def stage(spark, docs: DataFrame, sf_dir: str, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the one with the smallest id.

    Rows that repeat id and text are one document. What goes is joined away, broadcast where it takes
    at most ``broadcast_bytes``, else by key.
    """
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    found = near_duplicates(docs, 5, 80)
    gone = written(found.where("n_shingles > 0 AND NOT doc_id <=> component_id").select("doc_id", "tkey").distinct(), "near-gone")
    again = written(found.where("doc_id <=> component_id OR n_shingles = 0").groupBy("doc_id", "tkey").count().where("count > 1").select("doc_id", "tkey"), "near-again")
    keyed = docs.select(*cols).withColumn("tkey", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))

    def join(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
        o = if_small(other.select(F.col("doc_id").alias("o_id"), F.col("tkey").alias("o_key")), broadcast_bytes)
        return rows.join(o, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("tkey") == F.col("o_key")), how)

    kept = join(keyed, gone, "left_anti")
    if not again.isEmpty():
        turn = Window.partitionBy("doc_id", "tkey").orderBy("lang", "source", "n_chars")
        once = join(kept, again, "left_semi").withColumn("turn", F.row_number().over(turn)).where("turn = 1").drop("turn")
        kept = join(kept, again, "left_anti").unionByName(once)
    return kept.select(*cols)


#: Counts the shared shingles of all pairs, so it is for small tables.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM d),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.rid <> b.rid GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
r(x, y) AS (SELECT rid, rid FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(doc_id) AS component_id FROM r JOIN d ON d.rid = r.y GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d JOIN m ON m.x = d.rid LEFT JOIN n ON n.rid = d.rid
"""
