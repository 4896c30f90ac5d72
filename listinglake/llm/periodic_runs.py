"""Periodic run detection (operator 13): runs of repeated words found by difference-cover LCE.

A run is a stretch of consecutive words with smallest period q and length of at least
max(``MIN_LENGTH``, 2q) that no neighbouring word extends. Documents are mapped in Arrow batches; the
words of many documents become one array of integers, numbered anew for every document, so that
documents never match each other, and every step below is a vector operation over all of them.

* Harmonic grid: the words that agree with the word p further on form blocks; a run of period p is a
  block of p or more positions, so it holds a multiple of p. Only the multiples of p are looked at,
  for every p up to half the longest document: n/1 + n/2 + ... = n log n pairs.
* LCE: how far two positions agree. Of a cover of residues modulo ``MODULUS`` any two positions reach
  two sampled ones after the same number of steps, below ``MODULUS``. So the words up to there are
  compared one by one, and beyond, the answer is the least LCP between the ranks of two sampled
  suffixes, read off a sparse table. Only the sampled suffixes (6 of 31) are sorted, by refining
  groups of equal prefixes word by word and then by doubling. Backward extension asks the same of
  the reversed words.
* A stretch found with several periods keeps the smallest: they are its multiples.

Documents of which no pair of the grid agrees in at least ``MIN_LENGTH / 2`` neighbouring words have
no run and need no sorting.

Defined results: null and blank texts have no words, no run, and digests of the empty string; words
are cut at ``[\\x20\\x09-\\x0D]+`` only; a null doc_id gets no planted repetition; repeated rows are
treated one by one; an empty table returns no rows; other columns are never read. A text is one row
and is held whole by its task (about 60 bytes of memory per word; a sparse table row per doubling).
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type, mapped

MIN_LENGTH = 12
# fixed values: a difference set modulo 31, every residue is the difference of two of its members
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
#: words of documents looked at together (a longer document is taken alone)
TOGETHER = 1 << 18


def _shifts() -> np.ndarray:
    """[i mod v, (j - i) mod v] → the least number of steps after which i and j are both sampled."""
    least = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    for i in range(MODULUS):
        for a in COVER:
            for b in COVER:
                d = (b - a) % MODULUS
                least[i, d] = min(least[i, d], (a - i) % MODULUS)
    return least


SHIFT = _shifts()
_PLACE = np.zeros(MODULUS, np.int64)
_PLACE[list(COVER)] = np.arange(len(COVER))


def _number(at: np.ndarray) -> np.ndarray:
    """Sampled position → its number among the sampled positions."""
    return at // MODULUS * len(COVER) + _PLACE[at % MODULUS]


class CoverLce:
    """LCE of positions i < j of an integer array (no negative numbers)."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.words = np.concatenate([words, np.full(MODULUS + 1, -1, words.dtype)])
        at = np.arange(0, self.n + MODULUS, MODULUS)[:, None] + np.array(COVER)
        self.at = at[at < self.n]
        self.rank, levels = self._sorted()
        self.table = self._sparse(self._lcp(levels))

    def _sorted(self):
        """Rank of every sampled suffix, and the ranks by the first MODULUS * 2^k words for every k
        that was needed."""
        at, words = self.at, self.words
        rank = np.zeros(len(at), np.int64)
        levels, unsettled = [], np.arange(len(at))

        def refine(part, key):
            """Order the members of each group of equal rank by the key."""
            order = np.lexsort((key, rank[part]))
            part, key = part[order], key[order]
            old = rank[part]
            starts = np.ones(len(part), bool)
            starts[1:] = old[1:] != old[:-1]
            cuts = starts.copy()
            cuts[1:] |= key[1:] != key[:-1]
            place = np.arange(len(part))
            rank[part] = old + np.maximum.accumulate(np.where(cuts, place, 0)) - np.maximum.accumulate(np.where(starts, place, 0))
            alone = cuts & np.append(cuts[1:], True)
            return part[~alone]

        for t in range(MODULUS):
            if not len(unsettled):
                break
            unsettled = refine(unsettled, words[np.minimum(at[unsettled] + t, self.n)])
        step = len(COVER)  # numbers of sampled positions per MODULUS words
        while len(unsettled):
            levels.append(rank.copy())
            further = unsettled + step
            unsettled = refine(unsettled, np.where(further < len(at), levels[-1][np.minimum(further, len(at) - 1)], -1))
            step *= 2
        return rank, levels

    def _lcp(self, levels) -> np.ndarray:
        """LCP of every sampled suffix with the one before it in rank."""
        by_rank = np.empty(len(self.at), np.int64)
        by_rank[self.rank] = np.arange(len(self.at))
        a, b = by_rank[:-1].copy(), by_rank[1:].copy()
        out = np.zeros(len(self.at), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            live = np.flatnonzero(np.maximum(a, b) < len(self.at))
            same = live[levels[k][a[live]] == levels[k][b[live]]]
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
            out[1 + same] += MODULUS << k
        first, second = self.at[by_rank[:-1]] + out[1:], self.at[by_rank[1:]] + out[1:]
        live = np.arange(len(first))
        while len(live):
            x, y = first[live], second[live]
            live = live[self.words[x] == self.words[y]]
            first[live] += 1
            second[live] += 1
            out[1 + live] += 1
        return out

    @staticmethod
    def _sparse(lcp: np.ndarray) -> np.ndarray:
        rows = max(1, len(lcp).bit_length())
        table = np.zeros((rows, max(1, len(lcp))), np.int32 if len(lcp) < 1 << 30 else np.int64)
        table[0, :len(lcp)] = lcp
        for k in range(1, rows):
            half = 1 << (k - 1)
            table[k] = table[k - 1]
            table[k, :-half] = np.minimum(table[k - 1, :-half], table[k - 1, half:])
        return table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        steps = SHIFT[i % MODULUS, (j - i) % MODULUS]
        out = steps.copy()
        live = np.flatnonzero(steps > 0)
        far = steps == 0
        for t in range(MODULUS):
            if not len(live):
                break
            same = self.words[i[live] + t] == self.words[j[live] + t]
            out[live[~same]] = t
            live = live[same]
            there = steps[live] == t + 1
            far[live[there]] = True
            live = live[~there]
        far = np.flatnonzero(far & (j + steps < self.n))
        x, y = self.rank[_number(i[far] + steps[far])], self.rank[_number(j[far] + steps[far])]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        k = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out[far] += np.minimum(self.table[k, low], self.table[k, high - (1 << k) + 1])
        return out


def _grid_pairs(words: np.ndarray, sizes: np.ndarray, least: int):
    """Pairs (i, period) of the harmonic grid with at least ``least`` agreeing neighbours, in blocks.
    ``sizes`` (falling) are the lengths of the documents in ``words``."""
    ends = np.cumsum(sizes)
    pad = np.concatenate([np.full(least, -2, words.dtype), words, np.full(least, -1, words.dtype)])
    found, held = [], 0

    def close(found):
        i = np.concatenate([h * p for p, h in found]) + least
        p = np.repeat(np.array([p for p, _ in found]), [len(h) for _, h in found])
        if least > 1:
            live = (pad[i + 1] == pad[i + 1 + p]) | (pad[i - 1] == pad[i - 1 + p])
            i, p = i[live], p[live]
        near = np.ones(len(i), np.int64)
        for way in (1, -1):
            live = np.arange(len(i))
            for t in range(1, least):
                x = i[live] + way * t
                live = live[pad[x] == pad[x + p[live]]]
                near[live] += 1
        ok = near >= least
        return i[ok] - least, p[ok]

    long_enough = len(sizes)
    for p in range(1, int(sizes[0]) // 2 + 1 if len(sizes) else 0):
        while sizes[long_enough - 1] < 2 * p:
            long_enough -= 1
        line = words[:ends[long_enough - 1]:p]
        hits = np.flatnonzero(line[1:] == line[:-1])
        if len(hits):
            found.append((p, hits))
            held += len(hits)
            if held > 1 << 20:
                yield close(found)
                found, held = [], 0
    if found:
        yield close(found)


def runs_of(documents: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """Documents as arrays of word numbers (distinct between documents) → for each its runs, rows of
    (start, length, period) by start and period. A run has ``min_length`` words or more (at least 2)."""
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(documents)
    order = sorted(range(len(documents)), key=lambda d: -len(documents[d]))
    order = [d for d in order if len(documents[d]) >= max(2, min_length)]
    if not order:
        return out
    sizes = np.array([len(documents[d]) for d in order])
    starts = np.cumsum(sizes) - sizes
    words = np.concatenate([documents[d] for d in order])
    pairs = list(_grid_pairs(words, sizes, max(1, -(-min_length // 2))))
    i, p = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    if not len(i):
        return out
    # only the documents with such a pair go on
    doc = np.searchsorted(starts, i, "right") - 1
    has = np.zeros(len(order), bool)
    has[doc] = True
    moved = np.cumsum(np.where(has, sizes, 0)) - np.where(has, sizes, 0)
    words = words[np.repeat(has, sizes)]
    i = i - starts[doc] + moved[doc]
    n = len(words)
    ahead = CoverLce(words)(i, i + p)
    behind = np.zeros(len(i), np.int64)
    inner = i > 0
    behind[inner] = CoverLce(words[::-1])(n - i[inner] - p[inner], n - i[inner])
    long_enough = ahead + behind >= np.maximum(p, min_length - p)
    start, length, p, doc = (i - behind)[long_enough], (ahead + behind + p)[long_enough], p[long_enough], doc[long_enough]
    by = np.lexsort((p, length, start))
    start, length, p, doc = start[by], length[by], p[by], doc[by]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    rows = np.stack([start - moved[doc], length, p], axis=1)[smallest]
    doc = doc[smallest]
    by = np.lexsort((rows[:, 2], rows[:, 0], doc))
    rows, doc = rows[by], doc[by]
    for d in np.flatnonzero(has):
        a, b = np.searchsorted(doc, [d, d + 1])
        out[order[d]] = rows[a:b]
    return out


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay when of every run only the first period is kept."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def planted_order(n: int, h: int) -> np.ndarray | None:
    """Where the words of a document with planted repetition come from; None: it has none."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, plant: bool = False) -> DataFrame:
    """For every document row: doc_id, n_words, runs (start, length, period), text with every run
    collapsed to its first period (words joined by one space). ``plant``: documents whose crc32 of the
    doc_id ends in 0 first get a repetition of their words, as ``planted_order`` says."""
    def batch(b: pa.RecordBatch) -> dict:
        texts, seeds = b.column("text").to_pylist(), b.column("h").to_pylist()
        out = {"doc_id": b.column("doc_id"), "n_words": [], "runs": [], "text": []}
        at = 0
        while at < len(texts):
            words, ids, total = [], [], 0
            while at < len(texts) and (not total or total < TOGETHER):
                cut = texts[at].split()
                numbers = _Numbers(total)
                own = np.fromiter(map(numbers.__getitem__, cut), np.int64, len(cut))
                moved = planted_order(len(cut), seeds[at]) if seeds[at] is not None else None
                words.append(cut if moved is None else [cut[k] for k in moved.tolist()])
                ids.append(own if moved is None else own[moved])
                total += len(cut)
                at += 1
            for cut, runs in zip(words, runs_of(ids, min_length)):
                if len(runs):
                    stay = collapsed(len(cut), runs)
                    kept = [w for w, s in zip(cut, stay.tolist()) if s]
                else:
                    kept = cut
                out["n_words"].append(len(cut))
                out["runs"].append(runs)
                out["text"].append(b" ".join(kept))
        sizes = np.array([len(r) for r in out["runs"]])
        flat = np.concatenate(out["runs"]).T
        out["runs"] = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
            pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in flat], ["start", "length", "period"]))
        out["n_words"] = pa.array(out["n_words"], pa.int64())
        out["text"] = pa.array(out["text"], pa.binary()).cast(pa.string())
        return out

    seed = F.crc32(F.col("doc_id").cast("string").cast("binary")) if plant else F.lit(None).cast("bigint")
    rows = docs.select("doc_id", seed.alias("h"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return mapped(rows, batch, f"doc_id {id_type(docs)}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, text string")


class _Numbers(dict):
    """Numbers words in order of appearance, from ``first`` on."""

    def __init__(self, first: int):
        super().__init__()
        self.next = count(first).__next__

    def __missing__(self, word):
        n = self[word] = self.next()
        return n


def run_digests(docs: DataFrame, min_length: int = MIN_LENGTH, plant: bool = False) -> DataFrame:
    """One row per document: the number of runs, the longest (ties: first, then smallest period), and
    digests of all runs and of the collapsed text."""
    found = periodic_runs(docs, min_length, plant)
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), lines.alias("lines"), "text")
    return rows.select("doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.shorter")).alias("length"),
                       F.col("best.period").alias("period"),
                       F.floor(-F.col("best.shorter") * 1000 / F.col("best.period")).cast("bigint").alias("exponent_milli"),
                       F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))
