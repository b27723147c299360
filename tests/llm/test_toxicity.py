import random

import numpy as np
from pyspark.sql import functions as F

from textlake.llm import toxicity as T


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in T.new_parameters(1).items()}
    words = ["alpha", "be", "gammä", "x"]
    inputs = T.Inputs(words)
    ids = np.array([[0, 1, 2, 3, 1], [2, 2, 0, -1, -1]])
    y = np.array([1.0, 0.0], np.float32)
    _, grad = T.gradients(p, inputs, ids, y)
    loss = lambda: T.gradients(p, inputs, ids, y)[0]
    for k, g in grad.items():
        flat = np.flatnonzero(np.abs(g).ravel() > 1e-6)
        for i in rng.choice(flat, min(6, len(flat)), replace=False):
            old = p[k].ravel()[i]
            p[k].ravel()[i] = old + 1e-3
            up = loss()
            p[k].ravel()[i] = old - 1e-3
            down = loss()
            p[k].ravel()[i] = old
            assert abs((up - down) / 2e-3 - g.ravel()[i]) < 2e-3 * max(1, abs(g.ravel()[i])), (k, i)


def plain(p):
    """Hashes of a word, and states over a window in one direction, in loops over characters, gates and states."""
    import math
    import zlib

    m, H = 0xFFFFFFFF, T.HIDDEN
    sig = lambda x: 1 / (1 + math.exp(-x))

    def hashes(w):
        c, grams = [32, *map(ord, w), 32], []
        for i in range(len(c) - 2):
            h3 = ((c[i] * 2654435761 + c[i + 1] * 2246822519) * 3266489917 + c[i + 2]) & m
            grams.append((h3 * 0x9E3779B1 & m) >> 18)
            if i + 3 < len(c):
                grams.append(((((h3 ^ 0x5BD1E995) * 668265263 + c[i + 3]) & m) * 0x9E3779B1 & m) >> 18)
        return zlib.crc32(w.encode()) % T.HASHED, grams

    def states(inputs, d):
        h, out = np.zeros(H), []
        for x in inputs:
            g, u = x @ p["in"][d] + p["bias"][d, 0], h @ p["rec"][d]
            new = np.zeros(H)
            for k in range(H):
                z, r = sig(g[k] + u[k]), sig(g[H + k] + u[H + k])
                c = math.tanh(g[2 * H + k] + r * u[2 * H + k])
                new[k] = (1 - z) * c + z * h[k]
            h = new
            out.append(h)
        return out

    return hashes, states


def test_network_against_plain_arithmetic():
    p = {k: v.astype(np.float64) for k, v in T.new_parameters(3).items()}
    rng = np.random.default_rng(1)
    p["bias"], p["pad"] = rng.standard_normal(p["bias"].shape) * 0.3, rng.standard_normal(p["pad"].shape)
    net = T.Network(p)
    words = "the quick brown fox jumps over the lazy dog again and again".split()
    hashes, states = plain(p)
    x = {w: np.concatenate((np.mean(p["char"][grams], axis=0), p["word"][word])) for w in set(words) for word, grams in [hashes(w)]}
    window = [x[w] for w in words] + [p["pad"]] * (T.WINDOW - len(words))
    forward, backward = states(window, 0), states(window[::-1], 1)[::-1]
    both = [np.concatenate(s) for s in zip(forward, backward)]
    e = [np.exp(np.tanh(s @ p["att"]) @ p["query"]) for s in both[: len(words)]]
    want = sum(a / sum(e) * s for a, s in zip(e, both)) @ p["out"] + p["b"][0]
    assert abs(float(net.logits([words])[0]) - want) < 1e-4


def test_windows_of_a_text_in_parts(monkeypatch):
    """However a text is cut into parts for the look-up, its windows are those of the whole."""
    net = T.Network(T.new_parameters(2))
    rng = random.Random(5)
    for n in (63, 64, 65, 100, 160, 161, 200, 1000):
        words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(n)]
        monkeypatch.setattr(T, "GROUP", 1 << 15)
        want = max(net.logits([words[s : s + T.WINDOW]])[0] for s in T.starts(n))
        for group in (32, 64, 96):
            monkeypatch.setattr(T, "GROUP", group)
            assert abs(net.logits([words])[0] - want) < 1e-5


def test_windows_cover_every_word():
    for n in (1, 31, 32, 33, 63, 64, 65, 96, 97, 128, 129, 1000):
        s = list(T.starts(n))
        assert s[0] == 0 and s[-1] + T.WINDOW >= n and all(b - a == T.STRIDE for a, b in zip(s, s[1:]))
        assert all(any(a <= k < a + T.WINDOW for a in s) for k in range(n))


def test_long_words_count_whole():
    net = T.Network(T.new_parameters())
    for n in (65, 96, 97, 300, 10_000):
        w = "".join(chr(0x4E00 + i) for i in range(n))
        pieces = T.words_of("a " + w + " b")[1:-1]
        assert pieces[0] == w[:64] and pieces[-1] == w[32 * (len(pieces) - 1) :] and all(32 < len(x) <= 64 for x in pieces)
        assert pieces[0] + "".join(x[32:] for x in pieces[1:]) == w
        middle = w[: n // 2 - 3] + "insult" + w[n // 2 + 3 :]
        one, other = net.logits([T.words_of(w), T.words_of(middle)])
        assert T.words_of(middle) != pieces and (n > 1000 or one != other)
    assert T.words_of("x" * 64 + " y") == ["x" * 64, "y"]


def make(rng, n, bad):
    words = ["".join(rng.choice(["ka", "lo", "mi", "tre"]) for _ in range(3)) for _ in range(n)]
    if bad:
        words[rng.randrange(n)] = "zug" + rng.choice(["ka", "lo", "mi", "tre"]) + "!"
    return " ".join(words)


def test_learns_cue_anywhere(spark, monkeypatch):
    rng = random.Random(4)
    data = [(i, make(rng, rng.choice([20, 90, 200]), i % 3 == 0), int(i % 3 == 0), 0.0) for i in range(500)]
    df = spark.createDataFrame(data, "doc_id long, text string, toxic int, score double")
    net = T.train(df.select("doc_id", "text", "score"), df.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (7, None), (-9, 1)], "doc_id long, toxic int")))
    new = [(i, make(rng, rng.choice([20, 90, 400]), i % 2 == 0), i % 2 == 0) for i in range(200)] + [(1, None, False), (2, "", False), (3, " .,! ", False), (4, make(rng, 100_000, True), True)]
    out = spark.createDataFrame(new, "doc_id long, text string, want boolean").withColumn("s", T.score(F.col("text"), net, spark)).collect()
    assert all(0 <= r.s <= 1 for r in out) and np.mean([(r.s >= 0.3) == r.want for r in out]) > 0.95
    assert all(r.s == 0 for r in out if r.text is None or not T.words_of(r.text))
    texts = [t for _, t, _ in new]
    whole = net.scores(texts)
    monkeypatch.setattr(T, "CACHED", 70_000)
    monkeypatch.setattr(T, "BLOCK", 7)
    assert np.allclose(whole, [net.scores([t])[0] for t in texts], atol=1e-5)


def test_no_labels(spark):
    net = T.train(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert net.scores(["hello", None])[0] < 0.3
