"""Toxicity (operator 5): a bidirectional GRU with attention pooling over character and word inputs.

Every word enters as a hashed word embedding beside the mean of its hashed character n-grams
(2 to 5, with word boundaries). Windows of ``WINDOW`` words, ``STRIDE`` apart and so overlapping, are read by two GRUs;
attention pools the states, a logistic unit scores the window, and a text scores as its highest window.
All windows of the whole text are scored. Training (numpy, Adam) uses at most about ``SAMPLE_ROWS``
labelled rows: as labels are per text, each round picks the highest windows of a toxic text as toxic
and the highest and some other windows of a clean text as clean. A part of the sample is kept back to
calibrate the scores.

What a word adds to the gates does not depend on its place, so it is computed once per distinct word
of a task.

Defined results: null and empty texts are scored as one empty window; without labels of both kinds
every score is the share of toxic labels (0 if there are none); a doc_id with several labels counts
as toxic if any says so; repeated rows are scored alike; null doc_ids are never learnt from; other
columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Grams, WordTable, chunks, id_type, mapped

SAMPLE_ROWS = 2400
WINDOW, STRIDE = 32, 16
BITS, DIM = 15, 8
BUCKETS = 1 << BITS
HIDDEN, ATTENTION = 8, 6
ROUNDS, BATCH, RATE = 10, 128, 0.015
EDGE = ".,;:!?\"'()[]{}#$%&*|<>-_=+~"


def word_inputs(raw: list[str]) -> Grams:
    return Grams([w.lower().strip(EDGE) for w in raw], (2, 3, 4, 5), BITS, BITS)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def windows(n: int) -> np.ndarray:
    """Token places of all windows of a text of n words, -1 behind its end."""
    starts = np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE)
    at = starts[:, None] + np.arange(WINDOW)
    return np.where(at < n, at, -1)


def _gru(gates: np.ndarray, places: np.ndarray, mask: np.ndarray, u: np.ndarray, cache: list | None) -> np.ndarray:
    """States (steps, rows, HIDDEN) of windows whose words' gates are at ``places`` (steps, rows)."""
    h = np.zeros((places.shape[1], HIDDEN), np.float32)
    out = np.empty((*places.shape, HIDDEN), np.float32)
    for t in range(len(places)):
        x, a = gates.take(places[t], axis=0), h @ u
        zr = sigmoid(x[:, :2 * HIDDEN] + a[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN:] + r * a[:, 2 * HIDDEN:])
        new = (c + z * (h - c)) * mask[t][:, None]
        if cache is not None:
            cache.append((h, z, r, c, a[:, 2 * HIDDEN:]))
        out[t] = h = new
    return out


def _gru_back(d_out: np.ndarray, mask: np.ndarray, u: np.ndarray, cache: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates (steps, rows, 3 * HIDDEN) and of u."""
    d_gates, d_u, d_h = np.zeros((len(cache), mask.shape[1], 3 * HIDDEN), np.float32), np.zeros_like(u), 0
    for t in range(len(cache) - 1, -1, -1):
        h, z, r, c, a_c = cache[t]
        d = (d_out[t] + d_h) * mask[t][:, None]
        d_c = d * (1 - z) * (1 - c * c)
        d_z = d * (h - c) * z * (1 - z)
        d_r = d_c * a_c * r * (1 - r)
        d_gates[t] = np.concatenate([d_z, d_r, d_c], axis=1)
        d_a = np.concatenate([d_z, d_r, d_c * r], axis=1)
        d_u += h.T @ d_a
        d_h = d * z + d_a @ u.T
    return d_gates, d_u


class Model:
    """Parameters by name; ``scale`` and ``shift`` calibrate a text's highest logit."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)

        def w(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"word": (0.1 * rng.standard_normal((BUCKETS, DIM))).astype(np.float32),
                  "char": (0.3 * rng.standard_normal((BUCKETS, DIM))).astype(np.float32),
                  "in": w(2 * DIM, 6 * HIDDEN), "in_b": np.zeros(6 * HIDDEN, np.float32),
                  "uf": w(HIDDEN, 3 * HIDDEN), "ub": w(HIDDEN, 3 * HIDDEN),
                  "att": w(2 * HIDDEN, ATTENTION), "att_b": np.zeros(ATTENTION, np.float32), "att_v": w(ATTENTION, 1),
                  "out": w(2 * HIDDEN, 1), "out_b": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def embed(self, words: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Word inputs from their word buckets, n-gram buckets and numbers of n-grams."""
        chars = np.add.reduceat(self.p["char"][grams], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        return np.concatenate([self.p["word"][words], chars.astype(np.float32)], axis=1)

    def gates(self, g: Grams) -> np.ndarray:
        return self.embed(g.words, g.ids, g.sizes) @ self.p["in"] + self.p["in_b"]

    def words(self) -> WordTable:
        return WordTable(lambda ws: self.gates(word_inputs(ws)), 6 * HIDDEN, most=300_000)

    def forward(self, gates: np.ndarray, places: np.ndarray, cache: dict | None = None) -> np.ndarray:
        """Logits of windows; places (rows, steps): rows of ``gates``, -1 for none. In here steps come first."""
        p, places = self.p, np.ascontiguousarray(places.T)
        mask = (places >= 0).astype(np.float32)
        cf, cb = ([], []) if cache is not None else (None, None)
        both = [np.ascontiguousarray(gates[:, :3 * HIDDEN]), np.ascontiguousarray(gates[:, 3 * HIDDEN:])]
        logits = np.empty(places.shape[1], np.float32)
        block = places.shape[1] if cache is not None else 2048
        for k in range(0, places.shape[1], block):
            at, m = places[:, k:k + block], mask[:, k:k + block]
            h = np.concatenate([_gru(both[0], at, m, p["uf"], cf), _gru(both[1], at[::-1], m[::-1], p["ub"], cb)[::-1]], axis=2)
            u = np.tanh(h @ p["att"] + p["att_b"])
            s = (u @ p["att_v"])[:, :, 0] + (m - 1) * 1e4
            a = np.exp(s - s.max(axis=0))
            a /= a.sum(axis=0)
            pooled = (a[:, :, None] * h).sum(axis=0)
            logits[k:k + block] = (pooled @ p["out"])[:, 0] + p["out_b"][0]
            if cache is not None:
                cache.update(mask=m, cf=cf, cb=cb, h=h, u=u, a=a, pooled=pooled, places=at)
        return logits

    def backward(self, d: np.ndarray, k: dict, n_words: int) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters above the word inputs, and of the words' gates."""
        p, g, mask = self.p, {}, k["mask"]
        g["out"], g["out_b"] = k["pooled"].T @ d[:, None], np.array([d.sum()], np.float32)
        d_pooled = d[:, None] * p["out"].T
        d_h = k["a"][:, :, None] * d_pooled
        d_a = (k["h"] * d_pooled).sum(axis=2)
        d_s = k["a"] * (d_a - (k["a"] * d_a).sum(axis=0))
        g["att_v"] = (k["u"] * d_s[:, :, None]).sum(axis=(0, 1))[:, None]
        d_u = d_s[:, :, None] * p["att_v"][:, 0] * (1 - k["u"] ** 2)
        g["att"], g["att_b"] = k["h"].reshape(-1, 2 * HIDDEN).T @ d_u.reshape(-1, ATTENTION), d_u.sum(axis=(0, 1))
        d_h = d_h + d_u @ p["att"].T
        df, g["uf"] = _gru_back(d_h[:, :, :HIDDEN], mask, p["uf"], k["cf"])
        db, g["ub"] = _gru_back(d_h[::-1, :, HIDDEN:], mask[::-1], p["ub"], k["cb"])
        d_gates = np.zeros((n_words + 1, 6 * HIDDEN), np.float32)
        np.add.at(d_gates, k["places"], np.concatenate([df, db[::-1]], axis=2))
        return g, d_gates[:n_words]

    def text_logits(self, texts: list[str], table: WordTable) -> np.ndarray:
        """Highest logit over all windows of each text."""
        out = np.full(len(texts), -np.inf)
        for a, b in chunks(texts):
            words = [texts[i].split() for i in range(a, b)]
            offset, own, places = 0, [], []
            for i, w in enumerate(words):
                at = windows(len(w))
                own.append(np.full(len(at), a + i))
                places.append(np.where(at >= 0, at + offset, -1))
                offset += len(w)
            own, places = np.concatenate(own), np.concatenate(places)
            ids = table.ids([x for w in words for x in w])
            gates = table.rows[np.append(ids, 0)]  # -1 reads the last: any row, it is masked
            np.maximum.at(out, own, self.forward(gates, places))
        return out

    def scores(self, texts: list[str], table: WordTable) -> np.ndarray:
        return sigmoid(self.scale * self.text_logits(texts, table) + self.shift)


@dataclass
class Constant:
    share: float

    def words(self):
        return None

    def scores(self, texts, table):
        return np.full(len(texts), self.share)


def sample(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels, half of the rows toxic if there are as many. The ids are few and bounded, so
    they are broadcast and the texts are read once, without a shuffle."""
    one = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out)
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    mark = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for value, part in ((1, 0.4), (0, 0.6)):
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, part * rows / max(1, sizes.get(value, 0))))).otherwise(share)
    ids = one.filter(mark < share).orderBy("doc_id").limit(2 * rows).toPandas()
    if ids.empty:
        return [], np.zeros(0)
    picked = docs.sparkSession.createDataFrame(ids[["doc_id", "toxic"]], f"doc_id {id_type(labels)}, toxic int")
    got = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
           .limit(4 * rows).toArrow().sort_by("doc_id"))
    return [t or "" for t in got.column("text").to_pylist()], np.array(got.column("toxic").to_pylist(), np.float64)


def _adam(p: np.ndarray, moments: list[np.ndarray], rows, grad: np.ndarray, rate: float, step: int) -> None:
    m, v = moments
    m[rows] += 0.1 * (grad - m[rows])
    v[rows] += 0.001 * (grad * grad - v[rows])
    p[rows] -= rate * (m[rows] / (1 - 0.9 ** step)) / (np.sqrt(v[rows] / (1 - 0.999 ** step)) + 1e-6)


def train(texts: list[str], y: np.ndarray, seed: int = 9):
    if len(set(y.tolist())) < 2:
        return Constant(float(y.mean()) if len(y) else 0.0)
    rng, model = np.random.default_rng(seed), Model()
    n_cal = len(texts) // 5
    order = rng.permutation(len(texts))
    cal, fit = order[:n_cal], order[n_cal:]
    vocabulary: dict[str, int] = {}
    tokens = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in texts[i].split()], np.int64) for i in fit]
    all_grams = word_inputs(list(vocabulary) or [""])
    wid, grams, sizes, first = all_grams.words, all_grams.ids, all_grams.sizes, all_grams.first
    places, own = [], []
    for i, t in enumerate(tokens):
        at = windows(len(t))
        places.append(np.where(at >= 0, np.append(t, -1)[at], -1))
        own.append(np.full(len(at), i))
    places, own = np.concatenate(places), np.concatenate(own)
    truth = y[fit][own]
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}
    step = 0
    weight = np.array([1.0, 1.0])
    for turn in range(ROUNDS):
        noise = rng.random(len(places))
        if turn < 3:  # no idea yet where the toxic words are: some windows of every text
            key, take = noise, 4
        else:
            key = model.forward(model.gates(all_grams), places)
            take = 2
        by = np.lexsort((-key, own))
        rank = np.empty(len(by), np.int64)
        starts = np.r_[0, np.flatnonzero(np.diff(own[by])) + 1]
        rank[by] = np.arange(len(by)) - np.repeat(starts, np.diff(np.r_[starts, len(by)]))
        chosen = np.flatnonzero(np.where(truth == 1, rank < (take if turn < 3 else 1), (rank < take) | (noise < 0.04)))
        rng.shuffle(chosen)
        positives = max(1, (truth[chosen] == 1).sum())
        weight[1] = min(4.0, (len(chosen) - positives) / positives)
        rate = RATE * (1 if turn < ROUNDS - 5 else 0.3)
        for k in range(0, len(chosen), BATCH):
            part = chosen[k:k + BATCH]
            used, inv = np.unique(places[part], return_inverse=True)
            inv = inv.reshape(len(part), WINDOW)
            shift = 1 if used[0] == -1 else 0
            used = used[shift:]
            at = np.where(inv >= shift, inv - shift, -1)
            spans = [np.arange(first[u], first[u] + sizes[u]) for u in used]
            g_ids, g_n = grams[np.concatenate(spans)] if spans else grams[:0], sizes[used]
            x = model.embed(wid[used], g_ids, g_n)
            gates = x @ model.p["in"] + model.p["in_b"]
            cache: dict = {}
            q = sigmoid(model.forward(np.concatenate([gates, gates[:1]]), at, cache))
            d = ((q - truth[part]) * np.where(truth[part] == 1, weight[1], 1) / len(part)).astype(np.float32)
            grad, d_gates = model.backward(d, cache, len(used))
            grad["in"], grad["in_b"] = x.T @ d_gates, d_gates.sum(axis=0)
            d_x = d_gates @ model.p["in"].T
            step += 1
            for name, gr in grad.items():
                _adam(model.p[name], moments[name], slice(None), gr, rate, step)
            # of the embeddings only the rows that the batch has move
            for name, ids, gr in (("word", wid[used], d_x[:, :DIM]),
                                  ("char", g_ids, np.repeat(d_x[:, DIM:] / g_n[:, None], g_n, axis=0))):
                rows, at = np.unique(ids, return_inverse=True)
                total = np.stack([np.bincount(at, gr[:, j], len(rows)) for j in range(DIM)], axis=1)
                _adam(model.p[name], moments[name], rows, total.astype(np.float32), rate, step)
    logits = model.text_logits([texts[i] for i in cal], model.words()) if n_cal else np.zeros(0)
    if len(set(y[cal].tolist())) == 2:  # logistic calibration of the texts' highest logits
        z, t = np.clip(logits, -15, 15), y[cal]
        s, b = 1.0, 0.0
        for _ in range(3000):
            e = sigmoid(s * z + b) - t
            s, b = max(0.05, s - 0.05 * float((e * z).mean())), b - 0.05 * float(e.mean())
        model.scale, model.shift = s, b
    return model


_TABLES: dict = {}


def predict(docs: DataFrame, model) -> DataFrame:
    """doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of parameters, 2 MB

    def batch(b: pa.RecordBatch) -> dict:
        m = shared.value
        if _TABLES.get("model") is not m:
            _TABLES.update(model=m, table=m.words())
        return {"doc_id": b.column("doc_id"), "score": m.scores([t.as_py() or "" for t in b.column("text")], _TABLES["table"]).astype(float)}

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return mapped(rows, batch, f"doc_id {id_type(docs)}, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    return predict(docs, train(*sample(docs, labels, held_out, rows)))
