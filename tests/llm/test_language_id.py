import random

import numpy as np
from pyspark.sql import functions as F

from textlake.llm import language_id as L

PARTS = {"aa": ["ba", "lo", "mi", "ra"], "bb": ["zu", "kre", "strö", "ng"], "cc": ["ée", "oui", "qu", "x"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(3)) for _ in range(n))


def test_learns_and_handles_odd_rows(spark):
    rng = random.Random(3)
    known = [(i, text(rng, lang, 20), lang, None) for i in range(300) for lang in PARTS] + [(-1, None, "aa", None), (-2, "x", None, None), (-3, "", "bb", None)]
    model = L.train(spark.createDataFrame(known, "doc_id long, text string, lang string, score double"), sample_rows=300)
    assert model.langs == ["aa", "bb", "cc"] and (model.weights == 0).mean() > 0.5
    new = [(i, text(rng, lang, rng.choice([3, 50])), lang) for i in range(60) for lang in PARTS] + [(0, None, "und"), (1, "", "und"), (2, "12 !? 😀", "und"), (3, text(rng, "bb", 100_000), "bb")]
    df = spark.createDataFrame(new, "doc_id long, text string, want string")
    out = df.select("want", L.identify(F.col("text"), model, spark).alias("p")).select("want", "p.*").collect()
    assert len(out) == len(new) and all(0 <= r.score <= 1 for r in out)
    assert np.mean([r.want == r.lang_pred for r in out]) > 0.98
    assert all(r.lang_pred == "und" for r in out if r.want == "und")


def test_no_rows(spark):
    model = L.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert model.predict("hello") == ("und", 0.0)


def plain_features(text):
    """Hashed 1-, 2- and 3-grams with their counts, character by character."""
    m, clean = 0xFFFFFFFF, " "
    for c in text.lower():
        if c.isalpha():
            clean += c
        elif clean[-1] != " ":
            clean += " "
    clean += " "
    out = {}
    for i in range(len(clean)):
        c = [ord(x) for x in clean[i : i + 3]]
        one = c[0] * 2654435761 & m
        two = ((one ^ 0x5BD1E995) + c[1] * 2246822519) & m if len(c) > 1 else None
        three = ((two ^ 0x27D4EB2F) * 3266489917 + c[2] * 668265263) & m if len(c) > 2 else None
        for h in (one, two, three):
            if h is not None:
                f = (h * 0x9E3779B1 & m) >> (32 - L.BITS)
                out[f] = out.get(f, 0) + 1
    return out


def test_counts_are_the_same_in_parts(monkeypatch):
    rng = random.Random(8)
    texts = ["ab " * 50, "  x", "a", "a1", "1a", "ΑΣ ΣΑΣ Σ, É", "".join(rng.choice("abÄß .,1\U0001f600ж") for _ in range(2000)), "q" * 40_000 + " 12 " + "zé" * 9000]
    want = [plain_features(t) for t in texts]
    for part in (1, 2, 3, 7, 64, 1 << 20):
        monkeypatch.setattr(L, "PART", part)
        for t, w in zip(texts, want):
            if len(t) // part < 10_000:
                assert dict(zip(*(x.tolist() for x in L.ngram_counts(t)))) == w
    assert L.ngram_counts("12 34" * 100) is None and L.ngram_counts("") is None and L.ngram_counts(None) is None


def test_long_text_counts_whole():
    t = "the quick brown Fox, 17 jumps. " * 100_000
    assert dict(zip(*(x.tolist() for x in L.ngram_counts(t)))) == plain_features(t)


def test_model_against_plain_arithmetic(spark):
    """Document frequencies, TF-IDF, FTRL and the temperature again, in loops of plain Python."""
    import math

    rng = random.Random(6)
    known = [(i, text(rng, lang, rng.choice([1, 2, 5])), lang) for i in range(15) for lang in PARTS]
    model = L.train(spark.createDataFrame(known, "doc_id long, text string, lang string"), sample_rows=10_000)
    counts = [(lang, plain_features(t)) for _, t, lang in known]
    df = {}
    for _, c in counts:
        for f in c:
            df[f] = df.get(f, 0) + 1
    idf = lambda f: math.log((1 + len(known)) / (1 + df.get(f, 0))) + 1

    def vector(c):
        v = {f: (1 + math.log(n)) * idf(f) for f, n in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {f: x / norm for f, x in v.items()} | {"bias": 1.0}

    key = lambda lc: (lc[0], np.array(sorted(lc[1]), np.uint16).tobytes(), L.tf(np.array([lc[1][f] for f in sorted(lc[1])])).tobytes())
    sample = [(lang, vector(c)) for lang, c in sorted(counts, key=key)]
    shuffled, langs = np.random.default_rng(11), ["aa", "bb", "cc"]
    order = shuffled.permutation(len(sample)) if len(sample) < 50 else None
    z, n, w = {}, {}, {}

    def weight(f, k):
        zi = z.get((f, k), 0.0)
        return 0.0 if abs(zi) <= 0.02 else -(zi - math.copysign(0.02, zi)) / ((1 + math.sqrt(n.get((f, k), 0.0))) / 0.5 + 0.001)

    def probabilities(x, t=1.0):
        s = [sum(v * weight(f, k) for f, v in x.items()) / t for k in range(3)]
        e = [math.exp(y - max(s)) for y in s]
        return [y / sum(e) for y in e]

    for _ in range(4):
        for i in shuffled.permutation(order):
            lang, x = sample[i]
            p = probabilities(x)
            was = {(f, k): weight(f, k) for f in x for k in range(3)}
            for k in range(3):
                for f, v in x.items():
                    g = v * (p[k] - (langs[k] == lang))
                    old = n.get((f, k), 0.0)
                    z[f, k] = z.get((f, k), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / 0.5 * was[f, k]
                    n[f, k] = old + g * g
    losses = {float(t): sum(-math.log(probabilities(sample[i][1], t)[langs.index(sample[i][0])]) for i in order) for t in np.geomspace(0.05, 5, 60)}
    assert losses[min(losses, key=lambda t: abs(t - model.temperature))] <= min(losses.values()) + 1e-3
    for t in [text(rng, lang, 4) for lang in PARTS for _ in range(5)]:
        p = probabilities(vector(plain_features(t)), model.temperature)
        lang, score = model.predict(t)
        assert lang == langs[int(np.argmax(p))] and abs(score - max(p)) < 1e-3


def test_held_out_accuracy(spark, sf):
    out = L.query(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a")).first()
    assert r.a > 0.95
