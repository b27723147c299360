import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from textlake.llm import periodic_runs as P


def plain_runs(words):
    """Every stretch, longest period by period, straight from the definition."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - s >= max(24, 3 * p):
                found.setdefault((s, i + p - s), p)
    return sorted((s, length, p) for (s, length), p in found.items())


def ids(words):
    number = {}
    return np.array([number.setdefault(w, len(number)) for w in words], np.int32)


def got(words):
    return [tuple(r) for r in P.runs(ids(words)).tolist()]


def random_words(rng):
    out = []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.randint(0, rng.choice([1, 2, 5, 50])) for _ in range(rng.randint(1, 30))]
        out += (unit * rng.choice([1, 1, 2, 3, 4, 9, 30]))[: rng.choice([10, 25, 70, 300])]
        if rng.random() < 0.3 and out:
            out[rng.randrange(len(out))] = 99
    return out


def test_equals_plain_search():
    rng, some = random.Random(1), 0
    for _ in range(1500):
        w = random_words(rng)
        want = plain_runs(w)
        assert got(w) == want, w
        some += bool(want)
    assert some > 300


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=120))
def test_two_words_only(w):
    assert got(w) == plain_runs(w)


def test_bounds():
    assert got([1] * 23) == [] and got([1] * 24) == [(0, 24, 1)]
    assert got(list(range(8)) * 3) == [(0, 24, 8)] and got((list(range(8)) * 3)[:-1]) == []
    assert got((list(range(9)) * 3)[:-1]) == [] and got(list(range(9)) * 3) == [(0, 27, 9)]
    # two runs share a border word, one lies within another's period
    unit = [1] * 24 + [2]
    assert got(unit * 3) == [(0, 24, 1), (0, 75, 25), (25, 24, 1), (50, 24, 1)]


def test_small_grid_steps(monkeypatch):
    monkeypatch.setattr(P, "GRID_ROWS", 7)
    rng = random.Random(2)
    for _ in range(150):
        w = random_words(rng)
        assert got(w) == plain_runs(w)


def test_kept():
    rows = np.array([(0, 24, 8), (30, 30, 3)], np.int64)
    assert [i for i, k in enumerate(P.kept(64, rows)) if k] == [*range(8), *range(24, 33), *range(60, 64)]


def test_long_text_in_bounded_time():
    w = list(range(50)) * 2000 + list(range(100, 20_000))
    assert got(w) == [(0, 100_000, 50)]
    assert got([7] * 60_000) == [(0, 60_000, 1)]


def plain_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_rows_on_odd_texts(spark):
    rng = random.Random(4)
    texts = [" ".join(map(str, random_words(rng))) for _ in range(150)]
    texts += ["", None, " \t\n", "x", "a\xa0b " * 30, "\x0b\x0ca b " * 40, "é 漢字 😀 " * 20, "word " * 5000, "a b c\n" * 8 + "tail"]
    rows = [(i, t, "q") for i, t in enumerate(texts)] + [(3, texts[3], "q")] * 2 + [(None, "k l " * 30, None)] + [(10_000 + i, "p q r s t u v " * rng.randint(1, 30), "z") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = P.digests(P.find_runs(P.damaged(df))).collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, out), key=key) == sorted((plain_row(d, t) for d, t, _ in rows), key=key)


def test_operator_rows(spark):
    df = spark.createDataFrame([(1, "a b " * 12 + "c", "x"), (1, "a b " * 12 + "c", "x"), (2, None, None)], "doc_id long, text string, runs string")
    out = P.find_runs(df)
    assert out.columns == ["doc_id", "text", "runs_", "runs", "collapsed"]
    assert sorted((r.doc_id, [tuple(x) for x in r.runs], r.collapsed, r.runs_ or "") for r in out.collect()) == [(1, [(0, 24, 2)], "a b c", "x")] * 2 + [(2, [], "", "")]
    assert P.digests(P.find_runs(df.limit(0))).count() == 0


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_query_against_plain_search(spark, sf, folder):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got_rows = sorted(map(tuple, P.query(spark, sf).collect()))
    want = sorted(plain_row(d.doc_id, d.text) for d in docs)
    assert [tuple(x) for x in got_rows] == want
    assert any(r[1] for r in want)
