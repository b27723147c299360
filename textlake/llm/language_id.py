"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1-, 2- and 3-grams of lower-cased letters, with a space for every run of other
characters. Document frequencies come from all rows that may be learned from; weights from a bounded
sample of them, by follow-the-regularised-leader with an elastic net (its L1 part leaves most weights
zero); a temperature fitted on sample rows kept apart calibrates the scores.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import table
from .token_counts import small_batches

BITS = 15
SIZE = 1 << BITS
#: Characters handled at once; longer texts are counted in such parts, the last two characters carried over.
PART = 1 << 20


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(feature indexes, counts); None if the text is null or has no letter. The same whatever PART is."""
    text, total = (text or "").lower(), None
    carry, after_letter, some = np.array([32], np.uint32), False, False
    for at in range(0, len(text), PART):
        codes = np.frombuffer(text[at : at + PART].encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters()[codes]
        some |= bool(is_letter.any())
        keep = is_letter.copy()  # of a run of other characters the first stays, as a space
        keep[1:] |= is_letter[:-1]
        keep[0] |= after_letter
        after_letter = bool(is_letter[-1])
        c = np.concatenate((carry, np.where(is_letter, codes, 32)[keep], [32] if at + PART >= len(text) else [])).astype(np.uint32)
        one = c * np.uint32(2654435761)
        two = (one[:-1] ^ np.uint32(0x5BD1E995)) + c[1:] * np.uint32(2246822519)
        three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(3266489917) + c[2:] * np.uint32(668265263)
        # the characters carried over have been counted, but for the first space
        seen = len(carry) if at else 0
        grams = np.concatenate((one[seen:], two[max(0, seen - 1) :], three[max(0, seen - 2) :]))
        features = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        if len(text) <= PART and len(features) < SIZE // 4:
            return np.unique(features.astype(np.int64), return_counts=True) if some else None
        found = np.bincount(features, minlength=SIZE)
        total = found if total is None else total + found
        carry = c[-2:]
    if not some:
        return None
    index = np.flatnonzero(total)
    return index, total[index]


def tf(counts: np.ndarray) -> np.ndarray:
    return (1 + np.log(counts)).astype(np.float32)


class Model:
    """Weights (SIZE by languages), intercepts, inverse document frequencies and temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray):
        self.langs, self.idf, self.temperature = langs, idf.astype(np.float32), 1.0
        self.weights, self.bias = np.zeros((SIZE, len(langs)), np.float32), np.zeros(len(langs), np.float32)

    def features(self, index: np.ndarray, tf: np.ndarray) -> np.ndarray:
        v = tf * self.idf[index]
        return v / max(float(np.sqrt(v @ v)), 1e-9)

    def logits(self, index: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return self.features(index, tf) @ self.weights[index] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        counted = ngram_counts(text) if self.langs else None
        if counted is None:
            return "und", 0.0
        p = softmax(self.logits(counted[0], tf(counted[1])) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(langs: list[str], idf: np.ndarray, sample: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.001, seed: int = 11) -> Model:
    """FTRL-proximal over four fifths of ``sample`` (language, feature indexes, tf), temperature on the rest."""
    model, rng = Model(langs, idf), np.random.default_rng(seed)
    order = rng.permutation(len(sample))
    held, train = (order[: len(order) // 5], order[len(order) // 5 :]) if len(order) >= 50 else (order, order)
    z, n = np.zeros((SIZE + 1, len(langs))), np.zeros((SIZE + 1, len(langs)))
    place = {v: i for i, v in enumerate(langs)}

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for i in rng.permutation(train):
            lang, index, tf = sample[i]
            rows, x = np.append(index, SIZE), np.append(model.features(index, tf), 1.0)
            zi, ni = z[rows], n[rows]
            w = weights(zi, ni)
            p = softmax(x @ w)
            p[place[lang]] -= 1
            g = x[:, None] * p
            new = ni + g * g
            z[rows] = zi + g - (np.sqrt(new) - np.sqrt(ni)) / alpha * w
            n[rows] = new
    w = weights(z, n).astype(np.float32)
    model.weights, model.bias = w[:SIZE], w[SIZE]
    logits, truth = np.array([model.logits(i, t) for _, i, t in (sample[k] for k in held)]), np.array([place[sample[k][0]] for k in held])
    if len(held):
        loss = lambda t: -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
        model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    return model


def train(known: DataFrame, sample_rows: int = 2000, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", most_languages: int = 500) -> Model:
    """A model from ``known`` rows with text and language.

    Two aggregates cover all rows: rows by language, and document frequencies (at most SIZE + 1 sums
    reach the driver). Weights are fitted on about ``sample_rows`` rows, an equal share for each
    language, picked by a hash of the id; their features are made on the executors, so what the
    driver gets is bounded whatever the texts' lengths. Over ``most_languages`` languages are an
    error, since the model's size and the literal map of shares grow with them. Repeated rows count
    each time; a table without rows gives a model that answers ``und``.
    """
    small_batches(known.sparkSession)
    rows = known.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where("t IS NOT NULL AND l IS NOT NULL")
    by_lang = {r.l: r.n for r in rows.groupBy("l").agg(F.count("*").alias("n")).limit(most_languages + 1).collect()}
    if len(by_lang) > most_languages:
        raise ValueError(f"over {most_languages} languages")
    if not by_lang:
        return Model([], np.zeros(SIZE))
    langs = sorted(by_lang)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs = np.zeros(SIZE, np.int64), 0
        for b in batches:
            for t in b["t"].to_pylist():
                if (counted := ngram_counts(t)) is not None:
                    df[counted[0]] += 1
                    docs += 1
        index = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"f": pa.array([*index, -1], pa.int32()), "n": pa.array([*df[index], docs], pa.int64())})

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [(lang, *n) for lang, n in ((lang, ngram_counts(t)) for lang, t in zip(b["l"].to_pylist(), b["t"].to_pylist())) if n is not None]
            yield pa.RecordBatch.from_pydict({"l": pa.array([x for x, _, _ in made], pa.string()), "f": pa.array([i.astype(np.uint16).tobytes() for _, i, _ in made], pa.binary()), "v": pa.array([tf(n).tobytes() for _, _, n in made], pa.binary())})

    sums = {r.f: r.n for r in rows.select("t").mapInArrow(frequencies, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()}
    df = np.zeros(SIZE)
    df[[f for f in sums if f >= 0]] = [n for f, n in sums.items() if f >= 0]
    idf = np.log((1 + sums.get(-1, 0)) / (1 + df)) + 1
    share = F.create_map(*[x for k, n in by_lang.items() for x in (F.lit(k), F.lit(min(1.0, sample_rows / len(langs) / n)))])
    picked = rows.where(F.pmod(F.xxhash64("i", F.lit("language")), F.lit(1_000_000)) < share[F.col("l")] * 1_000_000)
    sample = [(r.l, np.frombuffer(r.f, np.uint16).astype(np.int64), np.frombuffer(r.v, np.float32)) for r in picked.mapInArrow(features, "l string, f binary, v binary").orderBy("l", "f", "v").collect()]
    return fit(langs, idf, sample)


def identify(text: Column, model: Model, spark) -> Column:
    """struct(lang_pred, score) for ``text``, whole: ``und`` and 0 where it is null or has no letter.

    Of languages with equal scores the first by name is taken. Each row has its own result, repeated ones too.
    """
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([held.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = train(docs.where(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), identify(F.col("text"), model, spark).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")
