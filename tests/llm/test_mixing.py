import hashlib
import random
import re

from textlake.llm.mixing import mix_sources

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows):
    """Targets by raising a common level until the shares are met; documents in order of their keys."""
    sizes = [len(WORD.findall(t or "")) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(n for n, r in zip(sizes, rows) if r[2] == s) for s in names}
    free, left, target = set(names), sum(total.values()), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= 3 * total[s]}
        if not over:
            target |= {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= 3 * total[s]
        free -= over
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    out = []
    for s in names:
        mine = sorted((md5(f":{'-' if d is None else d}:{md5(t or '')}"), d, n) for (d, t, src), n in zip(rows, sizes) if src == s)
        taken, budget = [0] * len(mine), int(target[s] + 1e-9)
        for _ in range(3):
            for i, (_, _, n) in enumerate(mine):
                k = min(n, budget)
                taken[i] += k
                budget -= k
        out += [(d, n, total[s], round(target[s], 6), k) for (_, d, n), k in zip(mine, taken)]
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rng = random.Random(1)
    for case in range(3):
        rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 7, 40, 900]))), rng.choice(["a", "a", "a", "b", "ü", "Z", "", None][: 2 + 3 * case])) for i in range(200)]
        rows += [(5, "same row", "a"), (5, "same row", "a"), (None, "no id \x0b here", "b"), (6, None, None), (7, "\t \n", "b"), (8, "x " * 50_000, "c")]
        rows += [(9, "one row many times", "d")] * 30  # the cut of this source is within rows that are alike
        df = spark.createDataFrame([(d, t, s, 0) for d, t, s in rows], "doc_id long, text string, source string, size int")
        got = [(r.doc_id, r.mx_size, r.mx_source_size, round(r.mx_target, 6), r.mx_taken) for r in mix_sources(df, ["doc_id", "size"], range_digits=(1, None, 3)[case], broadcast_bytes=(1 << 20, 0, 1 << 20)[case]).collect()]
        assert sorted(got, key=repr) == brute(rows)
        by = {}
        for (d, n, total, target, taken) in got:
            assert 0 <= taken <= 3 * n
            by.setdefault((total, target), []).append(taken)


def test_epochs_and_clashing_names(spark):
    df = spark.createDataFrame([(i, "w " * (i % 9), "ab"[i > 50], i) for i in range(70)], "doc_id long, text string, source string, mx_size int")
    out = mix_sources(df, ["doc_id", "mx_size"])
    assert out.columns == ["doc_id", "mx_size_", "mx_size", "mx_source_size", "mx_target", "mx_taken", "mx_epochs"]
    for r in out.collect():
        assert r.mx_size == r.doc_id % 9 and r.mx_size_ == r.doc_id and sum(r.mx_epochs) == r.mx_taken and sorted(r.mx_epochs, reverse=True) == r.mx_epochs


def test_no_rows_and_no_words(spark):
    schema = "doc_id long, text string, source string"
    assert mix_sources(spark.createDataFrame([], schema), ["doc_id"]).count() == 0
    out = mix_sources(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema), ["doc_id"]).collect()
    assert sorted((r.doc_id, r.mx_target, r.mx_taken) for r in out) == [(1, 0.0, 0), (2, 0.0, 0)]
