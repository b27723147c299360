"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Words over 64 characters (text without spaces) are cut into overlapping pieces, each a word. A word's
input is a hashed word vector next to the mean of its hashed character 3- and 4-gram vectors. Windows of 64 words that overlap by half cover a text from its first word to its last; a
forward and a backward GRU read each, attention pools the states, and a linear layer gives a logit.
A text's logit is its highest window's; a logistic fit on sample rows kept apart makes it a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import table
from .token_counts import small_batches

WORDS = re.compile(r"\w+")
WINDOW, STRIDE = 64, 32
HASHED, CHARS, WORD_DIM, HIDDEN, ATTEND = 1 << 14, 16, 8, 12, 12
#: Words whose gate inputs one Python worker keeps, windows that run at once, most characters of a word.
CACHED, BLOCK, WORD_CHARS = 100_000, 1024, 64
#: Words that are looked up together; with a part's last stride twice of it at most, so they always fit the cache.
GROUP = 1 << 15


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def words_of(text: str | None) -> list[str]:
    """Words of ``text``, lower-cased; those over WORD_CHARS as pieces of so many that overlap by half, to the end."""
    words = WORDS.findall(text.lower()) if text else []
    if not words or max(map(len, words)) <= WORD_CHARS:
        return words
    half = WORD_CHARS // 2
    return [w[s : s + WORD_CHARS] for w in words for s in (range(0, len(w) - half, half) if len(w) > WORD_CHARS else (0,))]


def starts(n: int) -> range:
    """First words of the windows over ``n`` words; the last window reaches the end."""
    return range(0, max(1, n - STRIDE), STRIDE)


class Inputs:
    """Hashes of distinct words: one word hash each, and the hashes of all character n-grams in a row."""

    def __init__(self, words: list[str]):
        self.word = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % HASHED for w in words], np.int64)
        c = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        inner, owner = c != 32, np.cumsum(c == 32) - 1
        h3 = (c[:-2] * np.uint32(2654435761) + c[1:-1] * np.uint32(2246822519)) * np.uint32(3266489917) + c[2:]
        h4 = (h3[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(668265263) + c[3:]
        ok3, ok4 = inner[1:-1], inner[1:-2] & inner[2:-1]
        hashes, of = np.concatenate((h3[ok3], h4[ok4])), np.concatenate((owner[1:-1][ok3], owner[1:-2][ok4]))
        order = np.argsort(of, kind="stable")
        self.gram = ((hashes * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int64)[order]
        self.of = of[order]
        self.first = np.searchsorted(self.of, np.arange(len(words)))
        self.size = np.diff(np.append(self.first, len(self.of))).astype(np.float32)

    def vectors(self, p: dict[str, np.ndarray], keep_word: np.ndarray | None = None) -> np.ndarray:
        if not len(self.word):
            return np.zeros((0, CHARS + WORD_DIM), np.float32)
        chars = np.add.reduceat(p["char"][self.gram], self.first) / self.size[:, None]
        word = p["word"][self.word]
        return np.concatenate((chars, word if keep_word is None else word * keep_word[:, None]), axis=1)


def new_parameters(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    scaled = lambda *s: (rng.standard_normal(s) / np.sqrt(s[-2])).astype(np.float32)
    return {
        "char": (rng.standard_normal((HASHED, CHARS)) * 0.3).astype(np.float32),
        "word": (rng.standard_normal((HASHED, WORD_DIM)) * 0.1).astype(np.float32),
        "pad": np.zeros(CHARS + WORD_DIM, np.float32),
        "in": scaled(2, CHARS + WORD_DIM, 3 * HIDDEN),
        "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
        "rec": scaled(2, HIDDEN, 3 * HIDDEN),
        "att": scaled(2 * HIDDEN, ATTEND),
        "query": scaled(ATTEND, 1)[:, 0],
        "out": scaled(2 * HIDDEN, 1)[:, 0],
        "b": np.zeros(1, np.float32),
    }


def gates(p: dict, x: np.ndarray) -> np.ndarray:
    """Gate inputs (2, rows, 3 H) of input vectors; the last row is the padding's."""
    return np.matmul(np.concatenate((x, p["pad"][None])), p["in"]) + p["bias"]


def run(p: dict, g: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Logits of windows ``ids`` (rows of ``g``, -1 is padding); with ``keep`` also what backward needs."""
    n, t = ids.shape
    h, H = np.zeros((2, n, HIDDEN), np.float32), HIDDEN
    states, saved = np.empty((t, 2, n, HIDDEN), np.float32), []
    for s in range(t):
        x = np.stack((g[0, ids[:, s]], g[1, ids[:, t - 1 - s]]))
        u = np.matmul(h, p["rec"])
        zr = sigmoid(x[..., : 2 * H] + u[..., : 2 * H])
        z, r = zr[..., :H], zr[..., H:]
        c = np.tanh(x[..., 2 * H :] + r * u[..., 2 * H :])
        if keep:
            saved.append((h, z, r, c, u[..., 2 * H :]))
        h = c + z * (h - c)
        states[s] = h
    both = np.concatenate((states[:, 0], states[::-1, 1]), axis=2)  # (t, n, 2 H), by place of the word
    a = np.tanh(both @ p["att"])
    e = a @ p["query"]
    e[ids.T < 0] = -1e9
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pooled = (w[..., None] * both).sum(axis=0)
    logit = pooled @ p["out"] + p["b"][0]
    return (logit, (saved, both, a, w, pooled)) if keep else logit


def summed(values: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """(size, ...) sums of ``values`` by ``rows``, of the same leading shape; -1 is the last row."""
    rows, values = rows.ravel(), values.reshape(rows.size, -1)
    order = np.argsort(rows, kind="stable")
    at = np.flatnonzero(np.diff(rows[order], prepend=-2))
    out = np.zeros((size, values.shape[1]), values.dtype)
    if len(at):
        out[rows[order[at]]] = np.add.reduceat(values[order], at, axis=0)
    return out


def gradients(p: dict, inputs: Inputs, ids: np.ndarray, truth: np.ndarray, keep_word: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss of windows and its gradients, by backpropagation through time."""
    H, (n, t) = HIDDEN, ids.shape
    x = inputs.vectors(p, keep_word)
    g = gates(p, x)
    logit, (saved, both, a, w, pooled) = run(p, g, ids, keep=True)
    prob = sigmoid(logit)
    loss = float(-(truth * np.log(prob + 1e-9) + (1 - truth) * np.log(1 - prob + 1e-9)).mean())
    d = ((prob - truth) / n).astype(np.float32)
    out = {"out": pooled.T @ d, "b": np.array([d.sum()], np.float32)}
    dpool = d[:, None] * p["out"]
    dw = (both * dpool).sum(axis=2)
    de = w * (dw - (w * dw).sum(axis=0))
    da = de[..., None] * p["query"] * (1 - a * a)
    out["query"], out["att"] = (de[..., None] * a).sum(axis=(0, 1)), np.einsum("tni,tnj->ij", both, da)
    dboth = w[..., None] * dpool + da @ p["att"].T
    dstates = np.stack((dboth[..., :H], dboth[::-1, :, H:]), axis=1)
    drec, dh, dsteps = np.zeros_like(p["rec"]), np.zeros((2, n, H), np.float32), np.empty((t, 2, n, 3 * H), np.float32)
    for s in range(t - 1, -1, -1):
        h, z, r, c, uc = saved[s]
        dh = dh + dstates[s]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * uc * r * (1 - r)
        du = np.concatenate((dz, dr, dc * r), axis=2)
        dsteps[s] = np.concatenate((dz, dr, dc), axis=2)
        drec += np.matmul(h.transpose(0, 2, 1), du)
        dh = dh * z + np.matmul(du, p["rec"].transpose(0, 2, 1))
    dg = np.stack((summed(dsteps[:, 0], ids.T, g.shape[1]), summed(dsteps[::-1, 1], ids.T, g.shape[1])))
    full = np.concatenate((x, p["pad"][None]))
    out["rec"], out["bias"] = drec, dg.sum(axis=1, keepdims=True)
    out["in"] = np.matmul(full.T, dg)
    dfull = np.matmul(dg, p["in"].transpose(0, 2, 1)).sum(axis=0)
    out["pad"], dvec = dfull[-1], dfull[:-1]
    out["char"] = summed((dvec[:, :CHARS] / inputs.size[:, None])[inputs.of], inputs.gram, HASHED)
    out["word"] = summed(dvec[:, CHARS:] * (1 if keep_word is None else keep_word[:, None]), inputs.word, HASHED)
    return loss, out


class Network:
    """Parameters, the score's logistic fit, and a cache of gate inputs by word."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.slope, self.shift = p, 1.0, 0.0
        self.forget()

    def __getstate__(self):
        return {"p": self.p, "slope": self.slope, "shift": self.shift}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.forget()

    def forget(self) -> None:
        """Starts the cache anew: places by word, and room for CACHED words' gate inputs and the padding's."""
        self.ids: dict[str, int] = {}
        self.g = np.empty((2, CACHED + 1, 3 * HIDDEN), np.float32)
        self.g[:, -1] = gates(self.p, np.zeros((0, CHARS + WORD_DIM), np.float32))[:, 0]

    def rows(self, words: list[str]) -> np.ndarray:
        """Places of words in ``self.g``, which gets those that it lacks."""
        new = {w for w in words if w not in self.ids}
        if new:
            if len(self.ids) + len(new) > CACHED:
                self.forget()
                new = set(words)
            new = sorted(new)
            at = len(self.ids)
            self.ids.update(zip(new, range(at, at + len(new))))
            g = np.concatenate([gates(self.p, Inputs(new[i : i + 4000]).vectors(self.p))[:, :-1] for i in range(0, len(new), 4000)], axis=1)
            self.g[:, at : at + len(new)] = g
        return np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))

    def logits(self, texts: list[list[str]]) -> np.ndarray:
        """Highest window logit of each word list; -inf where there are no words."""
        best = np.full(len(texts), -np.inf, np.float32)
        held, size = [], 0
        for i, words in enumerate(texts):
            for at in range(0, max(1, len(words) - STRIDE) if words else 0, GROUP):  # parts that overlap by a stride, so their windows are the text's
                held.append((i, words[at : at + GROUP + STRIDE]))
                size += len(held[-1][1])
                if size >= GROUP:
                    self.group(held, best)
                    held, size = [], 0
        self.group(held, best)
        return best

    def group(self, parts: list[tuple[int, list[str]]], best: np.ndarray) -> None:
        """Raises ``best`` by the windows of ``parts`` (text's place, words), whose new words are looked up together."""
        rows, at, windows, of = self.rows([w for _, words in parts for w in words]), 0, [], []
        for i, words in parts:
            windows += [rows[at + s : at + min(s + WINDOW, len(words))] for s in starts(len(words))]
            of += [i] * (len(windows) - len(of))
            at += len(words)
        self.flush(windows, of, best)

    def flush(self, windows: list[np.ndarray], of: list[int], best: np.ndarray) -> None:
        for a in range(0, len(windows), BLOCK):
            part = windows[a : a + BLOCK]
            ids = np.full((len(part), WINDOW), -1, np.int64)
            for row, w in zip(ids, part):
                row[: len(w)] = w
            np.maximum.at(best, of[a : a + BLOCK], run(self.p, self.g, ids))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = self.logits([words_of(t) for t in texts])
        return np.where(np.isfinite(x), sigmoid(self.slope * np.where(np.isfinite(x), x, 0) + self.shift), 0.0).astype(np.float64)


def fit(sample: list[tuple[int, list[list[str]]]], epochs: int = 9, batch: int = 64, rate: float = 0.01, seed: int = 5) -> Network:
    """A network from (label, windows of words) of each sample text.

    First every window has its text's label, two of each text; then the text's highest window has it,
    and negative texts add their second highest. Adam; word vectors are dropped half of the time so
    that characters carry what they can. A fifth of the texts fits slope and shift of the score.
    """
    rng, net = np.random.default_rng(seed), Network(new_parameters(seed))
    p = net.p
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    order = rng.permutation(len(sample))
    held, train = (order[: len(order) // 5], order[len(order) // 5 :]) if len(order) >= 100 else (order, order)
    for epoch in range(epochs):
        chosen: list[tuple[list[str], int]] = []
        if epoch < 2:
            for i in train:
                label, windows = sample[i]
                chosen += [(windows[k], label) for k in rng.permutation(len(windows))[:2]]
        else:
            net.forget()
            flat = [w for i in train for w in sample[i][1]]
            x, at = net.logits(flat), 0
            for i in train:
                label, windows = sample[i]
                top = np.argsort(-x[at : at + len(windows)])[: 1 if label else 2]
                chosen += [(windows[k], label) for k in top]
                at += len(windows)
        lr = rate * (1 - epoch / epochs) + rate * 0.05
        for some in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // batch)) if chosen else ():
            part = [chosen[i] for i in some]
            distinct = {w: k for k, w in enumerate(sorted({w for ws, _ in part for w in ws}))}
            ids = np.full((len(part), WINDOW), -1, np.int64)
            for row, (ws, _) in zip(ids, part):
                row[: len(ws)] = [distinct[w] for w in ws]
            keep = (rng.random(len(distinct)) < 0.5).astype(np.float32) * 2
            _, grad = gradients(p, Inputs(list(distinct)), ids, np.array([y for _, y in part], np.float32), keep)
            step += 1
            for k, gk in grad.items():
                gk = gk + 1e-6 * p[k] if k in ("char", "word") else gk
                m[k] += 0.1 * (gk - m[k])
                v[k] += 0.01 * (gk * gk - v[k])
                p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    net.forget()
    x = np.array([net.logits(sample[i][1]).max() for i in held]) if len(held) else np.zeros(0)
    y = np.array([sample[i][0] for i in held])
    if 0 < y.sum() < len(y):
        for _ in range(2000):
            q = sigmoid(net.slope * x + net.shift) - y
            net.slope -= 0.1 * (float((q * x).mean()) + 0.02 * (net.slope - 1))
            net.shift -= 0.1 * float(q.mean())
    elif len(y):
        net.slope, net.shift = 0.0, 8.0 if y.all() else -8.0
    else:
        net.slope, net.shift = 0.0, -8.0
    net.forget()
    return net


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 3000, windows_each: int = 1024, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id") -> Network:
    """A network from about ``sample_rows`` labelled rows, two fifths of them toxic where there are enough.

    Ids are picked from ``labels`` by a hash, so only that many are broadcast to meet the texts. A
    text gives all its windows, of over about 32,800 words ``windows_each``, spread evenly. They are
    cut on the executors: what the driver gets is bounded whatever the texts' lengths. Null labels and texts without words are
    passed over, an id labelled both ways is toxic; no rows at all give a network that scores near 0.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")).where("i IS NOT NULL AND y IN (0, 1)").groupBy("i").agg(F.max("y").alias("y"))
    n = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    quota = {1: min(n.get(1, 0), sample_rows * 2 // 5)}
    quota[0] = min(n.get(0, 0), sample_rows - quota[1])
    share = F.when(F.col("y") == 1, F.lit(quota[1] / max(1, n.get(1, 0)))).otherwise(F.lit(quota[0] / max(1, n.get(0, 0))))
    picked = known.where(F.pmod(F.xxhash64(F.col("i").cast("string"), F.lit("toxicity")), F.lit(1_000_000)) < share * 1_000_000)
    picked = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL").join(F.broadcast(picked), "i")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, windows = [], []
            for t, y in zip(b["t"].to_pylist(), b["y"].to_pylist()):
                if words := words_of(t):
                    at = list(starts(len(words)))
                    at = [at[k] for k in sorted({int(x) for x in np.linspace(0, len(at) - 1, min(len(at), windows_each))})]
                    labels.append(y)
                    windows.append([" ".join(words[s : s + WINDOW]) for s in at])
            yield pa.RecordBatch.from_pydict({"y": pa.array(labels, pa.int32()), "w": pa.array(windows, pa.list_(pa.string()))})

    got = picked.select("t", "y").mapInArrow(cut, "y int, w array<string>").toPandas()
    pool: dict[str, str] = {}  # one object a distinct word
    sample = sorted((int(y), [[pool.setdefault(x, x) for x in w.split(" ")] for w in ws]) for y, ws in zip(got.y, got.w))
    del got
    return fit(sample)


def score(text: Column, network: Network, spark) -> Column:
    """Score of ``text``, whole: 0 to 1; 0 where it is null or has no word. Each row has its own, repeated ones too."""
    small_batches(spark)
    held = spark.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(held.value.scores(texts.tolist()))

    return scores(text)


def learnt(spark, sf_dir: str) -> Network:
    """Learnt from the labels of rows whose crc32(doc_id) mod 4 is not 2."""
    return train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out()))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def query(spark, sf_dir, threshold: float = 0.3) -> DataFrame:
    network = learnt(spark, sf_dir)
    rows = table(spark, sf_dir, "documents").select("doc_id", held_out().alias("held_out"), score(F.col("text"), network, spark).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def stage(spark, docs: DataFrame, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """Documents that score under the threshold."""
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    network = learnt(spark, sf_dir)
    return docs.select(*cols).where(score(F.col("text"), network, spark) < threshold)
