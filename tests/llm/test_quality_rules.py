import random
import re

from textlake.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for at in places.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(covered)


def brute_kept(rows):
    """Verdict of each of ``rows`` (text, language, source), with quartiles from sorted lists."""
    figures = []
    for t, _, _ in rows:
        n, chars, symbols, lines, dup, rep = brute(t)
        ratios = [chars * 100 // max(n, 1), symbols * 1000 // max(n, 1), dup * 1000 // max(lines, 1), rep * 1000 // max(n, 1)]
        figures.append((n, rep, ratios))
    pools = {}
    for (n, _, ratios), (_, lang, source) in zip(figures, rows):
        if n:
            for key in ((lang, source), (lang,), ()):
                pools.setdefault(key, []).append([v >> max(0, v.bit_length() - 7) << max(0, v.bit_length() - 7) for v in ratios])
    out = []
    for (n, rep, ratios), (_, lang, source) in zip(figures, rows):
        pool = next((pools[k] for k in ((lang, source), (lang,)) if len(pools.get(k, ())) >= 50), pools.get((), []))
        ok = n >= 10 and 100 * rep <= 20 * n
        for k, slack in enumerate((60, 100, 350, 180)):
            if ok:
                v = sorted(p[k] for p in pool)
                low, high = v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]
                width = max(6 * (high - low), slack)
                ok = ratios[k] <= high + width and (k or ratios[k] >= low - width)
        out.append(bool(ok))
    return out


def test_figures_against_brute_force(spark):
    rng = random.Random(6)
    bits = ["a", "b", "c", "dé", "😀", "#", "&&", " ", "  ", "\n", "\t", "\x0b", "a b c d e ", "line one\n", "\x85", "\xa0"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(400)] + [None, "", " ", "\n\n", "a " * 30_000, "a b c d e f " * 3, "x\n" * 50]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    assert "n_words_" in Q.base_figures(df).columns
    for r in Q.base_figures(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == brute(r.text), repr(r.text)[:80]


def test_sketch_bins(spark):
    from pyspark.sql import functions as F

    v = [*range(300), 1000, 4095, 4096, 10**6, 2**40 + 12345]
    out = spark.createDataFrame([(x,) for x in v], "v long").select("v", Q.bin_of(F.col("v")).alias("b")).selectExpr("v", "b", f"{Q.bin_low('b')} AS low").collect()
    for r in out:
        assert r.low <= r.v and r.v - r.low <= r.v / 64
    assert [r.b for r in out] == sorted(r.b for r in out)


def test_verdicts(spark):
    rng = random.Random(2)
    clean = lambda: " ".join("".join(rng.choice("abcdefghi") for _ in range(rng.randint(2, 8))) for _ in range(60))
    rows = [(i, clean(), "en", "s" if i % 3 else None, False) for i in range(300)]
    rows += [(1000, clean().replace(" ", " %%% "), "en", "s", False), (1001, "few words", "en", "s", False), (1002, None, None, None, False), (1003, "w" * 4000 + " a b c d e f g h i j k", "en", "rare", False), (1004, clean(), None, None, True), (1004, clean(), None, None, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept boolean")
    out = Q.judge(df.withColumnRenamed("kept", "was"), ["doc_id"]).collect()
    assert len(out) == len(rows)
    assert {r.doc_id for r in out if not r.kept} == {1000, 1001, 1002, 1003}
    assert {r.doc_id for r in out if r.base_failed} == {1001, 1002}
    assert [r.kept for r in sorted(out, key=lambda r: (r.doc_id, r.kept))] == [k for _, k in sorted(zip([r[0] for r in rows], brute_kept([r[1:4] for r in rows])))]
    assert Q.judge(df, ["kept", "doc_id"]).columns[:2] == ["kept_", "doc_id"]
    salted = Q.judge(df, ["doc_id"], broadcast_bytes=0).collect()
    assert sorted((r.doc_id, r.kept) for r in salted) == sorted((r.doc_id, r.kept) for r in out)
    assert Q.judge(df.limit(0), ["doc_id"]).count() == 0
