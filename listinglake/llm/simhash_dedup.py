"""SimHash near-dedup (operator 3): pigeonring candidate filtering.

Fingerprint: words are runs outside ``[\\x20\\x09-\\x0D]`` of the text with A-Z lower-cased, features
are the shingles of ``k`` words with repeats, a bit is set if it is set in over half of the shingles'
XXH64 values (seed 42).

Linking: with ``d`` allowed differences the 64 bits are cut into d + 1 segments on a ring. If two
fingerprints differ in at most d bits, some chain of consecutive segments keeps its first l segments
within floor(l * d / (d + 1)) = l - 1 differences for every l. The first two steps of that budget
make the join key (first segment equal, at most one bit off in the second: a fingerprint sits in its
own key and visits the keys with one zero bit set), the further steps prune candidates, and the full
Hamming distance decides. Keys that many fingerprints share are cut into blocks and handled block
pair by block pair; each task returns a spanning forest of the links it finds, not all pairs, so
groups of any size stay linear in the output, and no link is lost.

Defined results: null or empty texts have fingerprint zero and link like any other; equal
fingerprints are one node; a component's id is its smallest non-null doc_id (null if it has none);
an empty table returns no rows; other columns are never read.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type, keyed_join, mapped, one_row_per_key, stored, text_hash, unpacked
from .components import components

#: rows of one block of a shared key; about twice as many meet in one comparison
BLOCK = 2048
#: one fingerprint in SAMPLE is looked at to find keys that need blocks (block sizes only, never results)
SAMPLE = 64
_STEP = 1 << 16


def simhash(text: str | None, k: int = 4) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _STEP):
        part = words[start:start + min(_STEP, n - start) + k - 1]
        shingles = map(b" ".join, zip(*(part[j:] for j in range(k)))) if len(words) >= k else [b" ".join(words)]
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, k: int = 4) -> DataFrame:
    """doc_id, _th, fp of every row."""
    def batch(b: pa.RecordBatch) -> dict:
        fps = [simhash(t.as_py(), k) for t in b.column("text")]
        return {"doc_id": b.column("doc_id"), "_th": b.column("_th"), "fp": pa.array(fps, pa.int64())}

    return mapped(docs.select("doc_id", text_hash().alias("_th"), F.col("text").cast("string").alias("text")),
                  batch, f"doc_id {id_type(docs)}, _th bigint, fp bigint")


def segments(d: int) -> list[tuple[int, int]]:
    """(shift, width) of the d + 1 segments."""
    edges = [64 * i // (d + 1) for i in range(d + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def ring_keys(fps: DataFrame, d: int) -> DataFrame:
    """key, fp, home: each fingerprint under its own key of every start, and as a visitor under the
    keys with one more bit set in the second segment."""
    segs = segments(d)

    def batch(b: pa.RecordBatch) -> dict:
        fp = b.column("fp").to_numpy(zero_copy_only=False)
        u = fp.view(np.uint64)
        keys, who, home = [], [], []
        for i, (s1, w1) in enumerate(segs):
            s2, w2 = segs[(i + 1) % len(segs)]
            first = (u >> np.uint64(s1)) & np.uint64((1 << w1) - 1)
            second = (u >> np.uint64(s2)) & np.uint64((1 << w2) - 1)
            base = (first << np.uint64(w2)) | second
            key = base * np.uint64(len(segs)) + np.uint64(i)
            keys.append(key), who.append(fp), home.append(np.ones(len(fp), bool))
            for bit in range(w2):
                free = (second >> np.uint64(bit)) & np.uint64(1) == 0
                keys.append((base[free] | np.uint64(1 << bit)) * np.uint64(len(segs)) + np.uint64(i))
                who.append(fp[free]), home.append(np.zeros(int(free.sum()), bool))
        return {"key": np.concatenate(keys).view(np.int64), "fp": np.concatenate(who), "home": np.concatenate(home)}

    return mapped(fps.select("fp"), batch, "key bigint, fp bigint, home boolean", rows=10_000)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a-b as stars: every node with the smallest node it is connected to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _within(x: np.ndarray, y: np.ndarray, key: np.ndarray, d: int, most: int) -> np.ndarray:
    """Chain budgets from the key's start onwards; after all segments the full Hamming distance."""
    segs = segments(d)
    start = key.view(np.uint64) % np.uint64(len(segs))
    diff = x.view(np.uint64) ^ y.view(np.uint64)
    ok = np.ones(len(x), bool)
    total = np.zeros(len(x), np.int64)
    counts = np.stack([np.bitwise_count((diff >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in segs])
    rows = np.arange(len(x))
    for step in range(len(segs)):
        total += counts[(start.astype(np.int64) + step) % len(segs), rows]
        ok &= total <= step
    return ok & (total <= most)


def match_sorted(group: np.ndarray, key: np.ndarray, fp: np.ndarray, home: np.ndarray, d: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links within the groups of rows sorted by group: row i against row i + lag for growing
    lags, for as long as some group is that long; two visitors never need to meet."""
    us, vs, held = [], [], 0
    at, lag = np.arange(len(group)), 0
    while len(at):
        lag += 1
        at = at[at + lag < len(group)]
        at = at[group[at] == group[at + lag]]
        c = at[(home[at] | home[at + lag]) & (fp[at] != fp[at + lag]) & (key[at] == key[at + lag])]
        c = c[_within(fp[c], fp[c + lag], key[c], d, most)]
        if len(c):
            us.append(fp[c]), vs.append(fp[c + lag])
            held += len(c)
            if held > 1_000_000:
                u, v = forest(np.concatenate(us), np.concatenate(vs))
                us, vs, held = [u], [v], len(u)
    return forest(np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def links(fps: DataFrame, d: int, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(u, v): links that span every connected group of distinct fingerprints within d bits."""
    ring = max(d, 2)  # two segments of a ring of three or more make a key that fits 64 bits
    keys = ring_keys(fps, ring)
    picked = ring_keys(fps.filter(F.pmod(F.xxhash64("fp"), F.lit(sample)) == 0), ring)
    hot = stored(picked.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") * sample > block)
                 .select("key", F.ceil(F.col("n") * sample / block).cast("long").alias("blocks")), "ring-hot")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.coalesce("blocks", F.lit(1)))
    pairs = (keys.join(hot, "key", "left")
             .select("key", "fp", "home", own.alias("own"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)).alias("other"))
             .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("grp"), "key", "fp", "home"))

    def run(batches):
        rest = None
        for b in batches:
            t = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "key", "fp", "home")}
            if rest is not None:
                t = {c: np.concatenate([rest[c], t[c]]) for c in t}
            if not len(t["grp"]):
                continue
            end = int(np.searchsorted(t["grp"], t["grp"][-1], "left"))  # the last group may go on
            rest = {c: x[end:] for c, x in t.items()}
            if end:
                u, v = match_sorted(t["grp"][:end], t["key"][:end], t["fp"][:end], t["home"][:end], ring, d)
                if len(u):
                    yield pa.RecordBatch.from_pydict({"u": u, "v": v})
        if rest is not None:
            u, v = match_sorted(rest["grp"], rest["key"], rest["fp"], rest["home"], ring, d)
            if len(u):
                yield pa.RecordBatch.from_pydict({"u": u, "v": v})

    return pairs.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, k: int = 4, d: int = 4, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """One row for each document row: doc_id, _th, fp, component (its smallest fingerprint), component_id."""
    rows = stored(fingerprints(docs, k), "fingerprints")
    reps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fp-reps")
    found = components(links(reps.select("fp"), d, block, sample)) if d else reps.select(F.col("fp").alias("node"), F.col("fp").alias("label"))
    labelled = (reps.join(stored(found, "fp-labels").withColumnRenamed("node", "fp"), "fp", "left")
                .select("fp", "rep", F.coalesce("label", "fp").alias("component")))
    # stored: both sides of the join get exchanges of their own, and a component with very many fingerprints is split
    roots = stored(labelled.groupBy("component").agg(F.min("rep").alias("component_id")), "fp-roots")
    classes = labelled.select("fp", "component").join(roots, "component").select("fp", "component", "component_id")
    return rows.join(stored(classes, "fp-classes"), "fp").select("doc_id", "_th", "fp", "component", "component_id")


def simhash_dedup(docs: DataFrame, k: int = 4, d: int = 4) -> DataFrame:
    """The documents with one row of each component, all columns as they were: the smallest doc_id
    (a null one only if there is no other), then the smallest (fingerprint, text hash)."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "_th")
    best = near_duplicates(docs, k, d).groupBy("component").agg(F.min(order).alias("b"))
    keys = best.select(F.col("b.doc_id").alias("doc_id"), F.col("b._th").alias("_th"))
    return unpacked(keyed_join(one_row_per_key(docs), stored(keys, "fp-stays"), "left_semi")).select(*docs.columns)
