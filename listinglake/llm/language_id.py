"""Language ID (operator 4): averaged hashed subword embeddings with a linear softmax.

A text's vector is the mean of the embeddings of all hashed character n-grams (2 to 4, with word
boundaries) and whole words of all its words; a linear softmax reads the language off it. Both are
trained together by stochastic gradient descent in numpy, on a sample bounded by ``SAMPLE_ROWS`` and
spread evenly over the languages. A part of the sample is kept back to fit the temperature of the
scores and the confidence below which an answer is not accepted.

As the model is linear, an n-gram's embedding enters only through its product with the softmax
weights; scoring sums these products, once per distinct word of a task.

Defined results: null texts and texts without a letter are ``und`` with score 0; an empty training
table knows no language, and every text is ``und``; repeated rows and null doc_ids are scored like
any other (null is not held out); other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Grams, WordTable, chunks, id_type, mapped

SAMPLE_ROWS, BITS, DIM = 2400, 15, 16
BUCKETS = 1 << BITS
EPOCHS, STEPS, BATCH, RATE = 12, 1000, 32, 20.0  # small samples are gone through until STEPS batches
MAX_ERROR = 0.01
LETTER = regex.compile(r"\p{L}")


def subwords(words: list[str]) -> Grams:
    return Grams(words, (2, 3, 4), BITS, BITS)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray      # bucket → logits (embedding times softmax weights)
    bias: np.ndarray
    temperature: float
    least: float           # scores below are not accepted

    def words(self) -> WordTable:
        width = len(self.languages) + 1

        def compute(words):
            grams = subwords(words)
            out = np.empty((len(words), width), np.float32)
            out[:, :-1] = grams.sums(self.table) + self.table[grams.words]
            out[:, -1] = grams.sizes + 1
            return out

        return WordTable(compute, width)

    def logits(self, sums: np.ndarray) -> np.ndarray:
        return sums[:, :-1] / np.maximum(sums[:, -1:], 1) + self.bias

    def probabilities(self, texts: list[str], table: WordTable) -> np.ndarray:
        sums = np.zeros((len(texts), len(self.languages) + 1))
        for a, b in chunks(texts):
            for i in range(a, b):
                words = texts[i].lower().split()
                for k in range(0, len(words), 100_000):
                    ids = table.ids(words[k:k + 100_000])  # before table.rows, which it may replace
                    sums[i] += table.rows[ids].sum(axis=0, dtype=np.float64)
        return softmax(self.logits(sums) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, where: Column, rows: int) -> tuple[list[str], list[str]]:
    """Texts and languages of at most about ``rows`` rows, as many of each language as there are."""
    usable = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & where)
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not sizes:
        return [], []
    each = max(20, rows // len(sizes))
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, each / n))).otherwise(share)
    mark = F.pmod(F.xxhash64("doc_id", "lang", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    got = usable.filter(mark < share).select("text", "lang", "doc_id").limit(2 * each * len(sizes)).toArrow().sort_by("doc_id")
    return got.column("text").to_pylist(), got.column("lang").to_pylist()


def train(texts: list[str], langs: list[str], seed: int = 5) -> Model | None:
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    y = np.array([names.index(x) for x in langs])
    rows = []
    for t in texts:
        words = t.lower().split()
        grams = subwords(words) if words else None
        ids, n = np.unique(np.concatenate([grams.ids, grams.words]) if words else np.zeros(0, np.int64), return_counts=True)
        rows.append((ids.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    order = rng.permutation(len(rows))
    n_cal = len(rows) // 5 if len(rows) >= 50 else 0
    cal, fit = order[:n_cal], order[n_cal:]
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(names)), np.float32), np.zeros(len(names), np.float32)

    def dense(which):
        x = np.zeros((len(which), BUCKETS), np.float32)
        for k, i in enumerate(which):
            x[k, rows[i][0]] = rows[i][1]
        return x

    batches = max(1, -(-len(fit) // BATCH))
    epochs, done = max(EPOCHS, -(-STEPS // batches)), 0
    steps = epochs * batches
    for _ in range(epochs):
        rng.shuffle(fit)
        for k in range(0, len(fit), BATCH):
            which = fit[k:k + BATCH]
            x = dense(which)
            hidden = x @ emb
            p = softmax(hidden @ out + bias)
            p[np.arange(len(which)), y[which]] -= 1
            p /= len(which)
            rate = RATE * (1 - done / steps)
            back = p @ out.T
            out -= 0.1 * rate * hidden.T @ p
            bias -= 0.01 * rate * p.sum(axis=0)
            emb -= rate * (x.T @ back)
            done += 1
    model = Model(names, emb @ out, bias, 1.0, 0.0)
    if n_cal:
        logits = np.concatenate([dense(cal[k:k + 64]) @ model.table for k in range(0, n_cal, 64)]) + bias
        truth, at = y[cal], np.arange(n_cal)
        model.temperature = float(min((0.1 * 1.25 ** k for k in range(25)),
                                      key=lambda t: -np.log(softmax(logits / t)[at, truth] + 1e-12).mean()))
        p = softmax(logits / model.temperature)
        top, wrong = p.max(axis=1), p.argmax(axis=1) != truth
        by = np.argsort(-top)
        good = np.flatnonzero(np.cumsum(wrong[by]) <= MAX_ERROR * np.arange(1, n_cal + 1))
        model.least = float(top[by[good[-1]]]) if len(good) else 1.0
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS times the languages

    def batch(b: pa.RecordBatch) -> dict:
        m = shared.value
        texts = [t.as_py() or "" for t in b.column("text")]
        fit = np.array([LETTER.search(t) is not None for t in texts])
        lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
        if m is not None:
            if "table" not in _TABLES or _TABLES["model"] is not m:
                _TABLES.update(model=m, table=m.words())
            p = m.probabilities([t if f else "" for t, f in zip(texts, fit)], _TABLES["table"])
            lang[fit] = np.array(m.languages, object)[p.argmax(axis=1)][fit]
            score[fit] = p.max(axis=1)[fit]
        return {"doc_id": b.column("doc_id"), "lang_pred": lang.tolist(), "score": score,
                "accepted": fit & (score >= (m.least if m else 1.0))}

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return mapped(rows, batch, f"doc_id {id_type(docs)}, lang_pred string, score double, accepted boolean")


_TABLES: dict = {}


def identify(docs: DataFrame, held_out: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Train on rows that are not held out, predict all."""
    return predict(docs, train(*sample(docs, ~held_out, rows)))
