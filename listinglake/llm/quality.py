"""Quality classifier (operator 6): a weak-label model and a hashed linear scorer.

Overlapping heuristic labellers vote good, bad or nothing on every document. Votes are counted over
all documents by pattern (3^12 at most, whatever the corpus), and
expectation-maximisation over the patterns, with one good class and a bad one for each kind of bad
documents (``KINDS``), estimates each labeller's accuracy and the share of good documents. The posterior of a pattern is the label of its documents: a sample bounded
by ``SAMPLE_ROWS``, spread over good and bad, trains a linear scorer on hashed features of every word
(its shape, its ending, whether it repeats the word before) by stochastic gradient descent.

A document is rejected if its score is below ``KEEP_FROM``.

Defined results: null and empty texts and texts of fewer than ``SHORT`` words get no vote; a text
without any word scores the corpus's share of good documents; without documents nothing is learnt and
everything would be kept; repeated rows are scored alike; other columns are never read, and come back
as they were.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, cut_batches, id_type, mapped

SAMPLE_ROWS, BITS = 3000, 14
SHORT, KEEP_FROM = 8, 0.5
EPOCHS, BATCH, RATE, SCALE = 12, 64, 0.3, 4.0

_ASCII_UPPER, _ASCII_LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_SYMBOLS = b"#$%&*|<>{}[]\\^~=+_@!?"
_DIGITS = b"0123456789"
_HIGH = bytes(range(128, 256))
_RUNS = [bytes([c, c]) for c in _SYMBOLS]
GOOD, BAD, NONE = 1, 0, 2


def _without(b: bytes, drop: bytes) -> int:
    return len(b) - len(b.translate(None, drop))


def _vote(value: float, good, bad) -> int:
    return GOOD if good(value) else BAD if bad(value) else NONE


def votes(text: str | None) -> list[int]:
    """One vote of each labeller; the thresholds are heuristics, their worth is estimated."""
    b = (text or "").encode()
    words = b.split()
    n = len(words)
    if n < SHORT:
        return [NONE] * LABELLERS
    size = sum(map(len, words))
    upper, lower = _without(b, _ASCII_UPPER), _without(b, _ASCII_LOWER)
    symbols, digits = _without(b, _SYMBOLS), _without(b, _DIGITS)
    ends = b.count(b".") + b.count(b"?") + b.count(b"!")
    repeats = sum(map(eq, words, words[1:])) / n
    lines = [x for x in b.split(b"\n") if x.strip()]
    return [
        _vote(symbols / size, lambda x: x < 0.01, lambda x: x > 0.06),          # symbol share
        _vote(upper / max(1, upper + lower), lambda x: x < 0.2, lambda x: x > 0.5),   # capitals
        _vote(repeats, lambda x: x < 0.03, lambda x: x > 0.2),                  # same word again and again
        _vote(len(set(words)) / n ** 0.85, lambda x: x > 0.5, lambda x: x < 0.2),     # distinct words for the length
        _vote(n / max(1, ends), lambda x: 3 <= x <= 40, lambda x: x > 80 or x < 1.5),  # words of a sentence
        _vote(size / n, lambda x: 3.5 <= x <= 9, lambda x: x < 2.5 or x > 14),  # word length
        _vote(digits / size, lambda x: x < 0.05, lambda x: x > 0.25),           # digits
        _vote(sum(len(w) <= 3 for w in words) / n, lambda x: 0.15 <= x <= 0.6, lambda x: x < 0.05 or x > 0.8),  # short words
        _vote(len(set(lines)) / len(lines), lambda x: x > 0.8, lambda x: x < 0.5),    # lines that repeat
        _vote((upper + lower + _without(b, _HIGH)) / size, lambda x: x > 0.92, lambda x: x < 0.82),  # letters
        _vote(sum(map(b.count, _RUNS)) / n, lambda x: x < 0.01, lambda x: x > 0.1),   # runs of one symbol
        _vote(sum(w[-1] in _SYMBOLS for w in words) / n, lambda x: x < 0.05, lambda x: x > 0.25),  # words that end in symbols
    ]


LABELLERS = 12
#: kinds of bad documents and the labellers that know them
KINDS = {"symbols": (0, 9, 10, 11), "repeats": (2, 3), "repeated lines": (8,), "tables": (0, 11), "numbers": (6, 9)}
NO_VOTES = sum(NONE * 3 ** i for i in range(LABELLERS))


def pattern_codes(docs: DataFrame) -> DataFrame:
    """doc columns ``text`` → code: the votes as a number in base 3."""
    def batch(b: pa.RecordBatch) -> dict:
        return {"doc_id": b.column("doc_id"), "text": b.column("text"),
                "code": pa.array([sum(v * 3 ** i for i, v in enumerate(votes(t.as_py()))) for t in b.column("text")], pa.int32())}

    return mapped(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                  batch, f"doc_id {id_type(docs)}, text string, code int")


@dataclass
class Labels:
    """What expectation-maximisation found: the share of good documents, each labeller's accuracy for
    bad and good votes (how often such a vote is right) and each pattern's posterior of being good."""
    share: float
    accuracy: np.ndarray
    posterior: dict[int, float]


def weak_labels(counts: dict[int, int], rounds: int = 300) -> Labels:
    """A good class and one for every kind of bad documents; a labeller votes bad, good or nothing with
    probabilities of its own in each class. The start takes a bad vote for rare among good documents and
    for usual among the labellers that know a kind; these never get less likely to vote bad on their kind
    than to vote good, so that no kind dissolves in the good class or turns into another one."""
    codes = np.array(sorted(c for c in counts if c != NO_VOTES), np.int64)
    n = np.array([counts[c] for c in codes], np.float64)
    v = codes[:, None] // 3 ** np.arange(LABELLERS) % 3
    is_vote = [v == k for k in (BAD, GOOD, NONE)]
    start = np.empty((1 + len(KINDS), 3, LABELLERS))                  # class (good first), P(bad, good, no vote), labeller
    start[0], start[1:] = np.array([[0.02], [0.63], [0.35]]), np.array([[0.2], [0.4], [0.4]])
    for c, known in enumerate(KINDS.values(), 1):
        start[c][:, known] = [[0.8], [0.05], [0.15]]
    emit, share = start.copy(), np.array([0.8] + [0.2 / len(KINDS)] * len(KINDS))
    post = np.repeat(share[:, None], len(codes), axis=1)
    for _ in range(rounds):
        of = np.stack([np.log(p) + sum(x @ np.log(e[k]) for k, x in enumerate(is_vote)) for p, e in zip(share, emit)])
        new = np.exp(of - of.max(axis=0, initial=-np.inf))
        new /= new.sum(axis=0)
        for c, w in enumerate(n * new):
            emit[c] = (np.stack([w @ x for x in is_vote]) + 20 * start[c]) / (w.sum() + 20)
        for c, known in enumerate(KINDS.values(), 1):
            for k in known:
                if emit[c, BAD, k] < emit[c, GOOD, k]:
                    emit[c, :2, k] = emit[c, :2, k].mean()
        share = (new @ n + 10 * np.array([0.8] + [0.2 / len(KINDS)] * len(KINDS))) / (n.sum() + 10)
        good = float(np.clip(share[0], 0.02, 0.98))
        share = np.r_[good, share[1:] / share[1:].sum() * (1 - good)]
        done, post = np.abs(new - post).max(initial=0) < 1e-7, new
        if done:
            break
    weighed = emit * share[:, None, None]
    accuracy = np.stack([weighed[1:, BAD].sum(axis=0) / weighed[:, BAD].sum(axis=0), weighed[0, GOOD] / weighed[:, GOOD].sum(axis=0)])
    return Labels(float(share[0]), accuracy, dict(zip(codes.tolist(), post[0].tolist())) | {NO_VOTES: float(share[0])})


_SHAPES = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "X"), (re.compile(r"[^\W\dX_]+"), "x"), (re.compile(r"\d+"), "0"))


def word_features(words: list[str]) -> np.ndarray:
    """Buckets of each word's shape, ending and length: (words, 3)."""
    shapes = "\n".join(words)
    for pattern, letter in _SHAPES:
        shapes = pattern.sub(letter, shapes)
    mask = (1 << BITS) - 1
    crc = zlib.crc32
    return np.array([(crc(f"s{x}".encode()) & mask, crc(f"e{w[-3:]}".encode()) & mask, crc(b"n%d" % min(len(w), 20)) & mask)
                     for x, w in zip(shapes.split("\n"), words)], np.int64).reshape(-1, 3)


def repeats(words: list[str]) -> int:
    """Words equal to the one before."""
    return sum(map(eq, words, words[1:]))


AGAIN = zlib.crc32(b"again") & ((1 << BITS) - 1)


@dataclass
class Scorer:
    weights: np.ndarray | None
    bias: float
    share: float

    def words(self) -> WordTable:
        return WordTable(lambda ws: self.weights[word_features(ws)].sum(axis=1, keepdims=True), 1, most=400_000)

    def scores(self, texts: list[str], table: WordTable) -> np.ndarray:
        out = np.full(len(texts), self.share)
        if self.weights is None:
            return out
        prior = np.log(self.share / (1 - self.share))
        for i, text in enumerate(texts):
            words = text.split()
            total = repeats(words) * float(self.weights[AGAIN])
            for k in range(0, len(words), 100_000):
                ids = table.ids(words[k:k + 100_000])  # before table.rows, which it may replace
                total += float(table.rows[ids].sum(dtype=np.float64))
            if words:  # a few words are little evidence: the logit starts at the corpus's share
                own = SCALE * total / len(words) + self.bias
                out[i] = 1 / (1 + np.exp(-np.clip(prior + (own - prior) * len(words) / (len(words) + SHORT), -50, 50)))
        return out


def train(texts: list[str], labels: np.ndarray, share: float, seed: int = 4) -> Scorer:
    """Logistic regression on posterior labels; a text's features are averaged over its words."""
    rows, y = [], []
    for t, label in zip(texts, labels):
        words = t.split()
        if words:
            ids, n = np.unique(np.append(word_features(words).ravel(), [AGAIN] * repeats(words)).astype(np.int64), return_counts=True)
            rows.append((ids, n * (SCALE / len(words))))
            y.append(label)
    if not rows:
        return Scorer(None, 0.0, share)
    y = np.array(y)
    rng, w, b, squares = np.random.default_rng(seed), np.zeros(1 << BITS), 0.0, np.full(1 << BITS, 1e-3)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            part = order[k:k + BATCH]
            x = np.zeros((len(part), 1 << BITS), np.float32)
            for i, r in enumerate(part):
                x[i, rows[r][0]] = rows[r][1]
            d = (1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50))) - y[part]) / len(part)
            grad = x.T @ d
            squares += grad * grad
            w -= RATE * grad / np.sqrt(squares)
            b -= RATE * d.sum()
    return Scorer(w.astype(np.float32), float(b), share)


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[Scorer, Labels | None]:
    coded = pattern_codes(docs)
    counts = {r["code"]: r["n"] for r in coded.groupBy("code").agg(F.count("*").alias("n")).collect()}  # 3^12 rows at most, a few hundred in practice
    if not counts:
        return Scorer(None, 0.0, 1.0), None
    found = weak_labels(counts)
    clear = {c: p for c, p in found.posterior.items() if c != NO_VOTES and c in counts}
    good = [c for c, p in clear.items() if p >= 0.5]
    bad = [c for c, p in clear.items() if p < 0.5]
    share = F.lit(0.0)
    for codes in (good, bad):
        n = sum(counts[c] for c in codes)
        if n:
            share = F.when(F.col("code").isin(codes), F.lit(min(1.0, rows / 2 / n))).otherwise(share)
    # the texts are looked at again, and only one in so many gets its votes a second time
    least = min(1.0, max([rows / 2 / max(1, sum(counts[c] for c in cs)) for cs in (good, bad) if cs], default=0.0))
    mark = F.pmod(F.xxhash64("doc_id", F.xxhash64("text"), F.lit(31)), F.lit(1 << 30)) / float(1 << 30)
    picked = pattern_codes(docs.filter(mark < least)).filter(mark < share).limit(2 * rows).toArrow().sort_by("doc_id")
    texts = picked.column("text").to_pylist()
    return train([t or "" for t in texts], np.array([found.posterior[c] for c in picked.column("code").to_pylist()]), found.share), found


_TABLES: dict = {}


def _batch_scores(model: Scorer, texts) -> np.ndarray:
    if _TABLES.get("model") is not model:
        _TABLES.update(model=model, table=model.words())
    return model.scores([t.as_py() or "" for t in texts], _TABLES["table"])


def score_quality(docs: DataFrame) -> DataFrame:
    """doc_id, score, keep."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs)[0])  # a fixed number of weights

    def batch(b: pa.RecordBatch) -> dict:
        s = _batch_scores(shared.value, b.column("text"))
        return {"doc_id": b.column("doc_id"), "score": s, "keep": s >= KEEP_FROM}

    return mapped(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                  batch, f"doc_id {id_type(docs)}, score double, keep boolean")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, in their own columns: rows only pass through Python, so
    neither a join nor a key is needed."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs)[0])

    def run(batches):
        for b in cut_batches(batches):
            texts = b.column(b.schema.get_field_index("text"))
            yield b.filter(pa.array(_batch_scores(shared.value, texts) >= KEEP_FROM))

    return docs.mapInArrow(run, docs.schema)
