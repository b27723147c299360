import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlake.llm import ngram_join as J
from textlake.llm.components import components


def brute_set(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lower = lower.replace(c, " ")
    w = [x for x in lower.split(" ") if x]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, n, percent):
    sets = [brute_set(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed, size):
    rng = random.Random(seed)
    common = "the of and to in a".split()
    word = lambda: rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("ka lo mi tre shu".split()) for _ in range(3))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(size):
        k = rng.random()
        if k < 0.45 and texts:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.choice([0, 1, 1, 2])] = [word() for _ in range(rng.choice([0, 1, 1, 2]))]
            texts.append(" ".join(w) or "x")
        else:
            texts.append(" ".join([word() for _ in range(rng.choice([1, 2, 3, 4, 30, 100, 300]))] + passage * (rng.random() < 0.3)))
    base = [word() for _ in range(150)]
    for i in range(size // 5):
        w = list(base)
        w[i % 150] = f"changed{i}"
        texts.append(" ".join(w))
    rows = [(i * 7 % 100_003, t.upper() if i % 11 == 0 else t) for i, t in enumerate(texts)]
    return rows + [(-5, None), (-6, ""), (-7, " \t\n"), (None, texts[0]), (rows[3][0], texts[3]), (rows[4][0], "other text entirely here"), (9_000_000, "Ä Ö Ü " * 20000), (9_000_001, "ä ö ü " * 20000)]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_against_brute_force(spark, n, percent):
    rows = corpus(n, 500)
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, n_shingles int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df, n, percent).collect()), key=repr)
    assert got == brute(rows, n, percent)


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (3, 95)])
def test_all_sizes_that_just_reach_the_threshold(spark, n, percent):
    rows = []
    for a in range(1, 51):
        for b in range(-(-percent * a // 100), a + 1):
            if (o := J.least_overlap(a, b, percent)) <= b:
                word = lambda kind, k: [f"{kind}{len(rows)}x{j}" for j in range(k)]  # noqa: E731, B023
                both = word("s", o + n - 1)
                rows += [(len(rows), " ".join(word("a", a - o) + both)), (len(rows) + 1, " ".join(both + word("b", b - o)))]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()), key=repr)
    assert got == brute(rows, n, percent)
    assert all(c == d - d % 2 for d, _, c in got)


def test_frequent_order_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(J, "SHARE", 30)
    monkeypatch.setattr(J, "SEGMENT", 100)
    rows = corpus(9, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    heavy, rank = J.frequent(df.select(F.col("text").alias("t")), 3)
    assert len(heavy) and len(set(rank)) == len(heavy)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df, 3, 90).collect()), key=repr)
    assert got == brute(rows, 3, 90)


def bucket(k, seed, roots):
    rng = np.random.default_rng(seed)
    n, pos, root = rng.integers(90, 130, k), rng.integers(0, 9, k), np.where(rng.random(k) < 0.7, 5, rng.integers(6, 6 + roots, k))
    root[rng.random(k) < 0.02] = 0
    return [(3, i.to_bytes(4, "big"), int(n[i]), int(pos[i]), int(root[i]), None if i % 2 else bytes(J.SKETCH)) for i in range(k)]


@pytest.mark.parametrize("k, roots, cell", [(600, 3, 256), (600, 3, 40), (500, 400, 64), (200, 3, 256), (300, 1, 10)])
def test_cells_give_all_pairs_of_a_bucket(spark, monkeypatch, k, roots, cell):
    """A bucket dealt to cells gives every pair that its rows, sizes, places and components ask for, and no cell is large."""
    monkeypatch.setattr(J, "CELL", cell)
    rows = bucket(k, 2, roots)
    entries = spark.createDataFrame(rows + [(7, *r[1:]) for r in rows[:9]], "token long, gid binary, n long, pos long, root long, sk binary")
    dealt = J.dealt(entries, False).cache()
    sizes = [r["count"] for r in dealt.groupBy("cell").count().collect()]
    assert k <= cell or max(sizes) <= 3 * cell + 30
    found = dealt.repartition("cell").sortWithinPartitions("cell", "n", "gid").mapInArrow(J.bucket_pairs(90, False), "ga binary, gb binary")
    got = {tuple(sorted((bytes(r.ga), bytes(r.gb)))) for r in found.collect()}
    fits = lambda a, b: 100 * min(a[2], b[2]) >= 90 * max(a[2], b[2]) and min(a[2] - a[3], b[2] - b[3]) >= J.least_overlap(a[2], b[2], 90) and (a[4] != b[4] or a[4] == 0)
    assert got == {tuple(sorted((a[1], b[1]))) for i, a in enumerate(rows) for b in rows[:i] if fits(a, b)}


def test_first_round_connects_a_crowded_bucket(spark):
    rows = [(3, i.to_bytes(4, "big"), 100 + i % 5, 0, 0, bytes(J.SKETCH)) for i in range(5000)]
    dealt = J.dealt(spark.createDataFrame(rows, "token long, gid binary, n long, pos long, root long, sk binary"), True).cache()
    assert max(r["count"] for r in dealt.groupBy("cell").count().collect()) < 2 * J.CELL
    found = dealt.repartition("cell").sortWithinPartitions("cell", "n", "gid").mapInArrow(J.bucket_pairs(90, True), "ga binary, gb binary").collect()
    root = {r[1]: r[1] for r in rows}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for r in found:
        root[find(bytes(r.ga))] = find(bytes(r.gb))
    assert len(found) < 15_000 and len({find(x) for x in root}) == 1


def test_small_blocks_and_ranges_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_ENTRIES", 200)
    monkeypatch.setattr(J, "RANGE_ENTRIES", 64)
    rows = corpus(4, 250)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df, 5, 80).collect()), key=repr)
    assert got == brute(rows, 5, 80)


def test_bitmaps_never_exceed_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.8], rng.integers(0, 1 << 63, rng.integers(0, 300)).astype(np.uint64), a[:1])))
        assert J.bits_apart(J.bitmap(a), J.bitmap(b)) <= len(np.setxor1d(a, b))


def test_empty_and_stage(spark):
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    assert J.stage(spark, spark.createDataFrame([], cols), "").count() == 0
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(5, t, "en", "a", 1), (4, t + " more", "en", "a", 1), (4, t + " more", "en", "a", 1), (9, "short one", None, None, None), (9, "short one", None, "x", None), (None, None, None, None, None), (8, "", "en", "a", 0), (7, "quite another text with words", "en", "b", 3)]
    for broadcast in (1_000_000, 0):
        out = J.stage(spark, spark.createDataFrame(rows, cols), "", broadcast).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 4), (False, 7), (False, 8), (False, 9), (True, 0)]


@pytest.mark.parametrize("most", [100_000, 0])
def test_components_of_a_path_and_a_star(spark, most):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), broadcast_links=most).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)}
