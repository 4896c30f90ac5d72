"""Scores recomputed text by text, the decontamination index, the digest index, batches and ids of other types."""

import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listinglake.llm import (common, decontaminate, exact_dedup, language_id, quality, simhash_dedup, substring_dedup, token_counts,
                             toxicity)

MASK = (1 << 64) - 1
MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
SCRIPTS = {"en": "the of and to in that is was he for it with as his on be at by had not", "fr": "le la les des est et que une dans qui sur pour pas au",
           "de": "der die das und ist nicht mit ein eine auf von zu den im für"}


def texts_of(rng, n, extra=()):
    out = []
    for i in range(n):
        lang = list(SCRIPTS)[i % 3]
        words = rng.choice(SCRIPTS[lang].split(), int(rng.integers(3, 90))).tolist()
        for w in extra:
            words[int(rng.integers(len(words)))] = w
        out.append((" ".join(words), lang))
    return out


# language ID

def gram_buckets(word, lengths, bits):
    codes = [ord(c) for c in f"<{word}>"]
    out = []
    for at in range(len(codes)):
        for k in lengths:
            if at + k <= len(codes):
                h = k
                for j in range(k):
                    h = ((h ^ codes[at + j]) * MIX[j]) & MASK
                    h ^= h >> 31
                out.append(((h * MIX[0]) & MASK) >> (64 - bits))
    return out


def word_bucket(word, bits):
    total = sum((ord(c) + 7) * ((place * MIX[1] + MIX[2]) & MASK | 1) for place, c in enumerate(f"<{word}>"))
    return ((total * MIX[0]) & MASK) >> (64 - bits)


def test_language_scores_text_by_text(spark):
    rng = np.random.default_rng(1)
    rows = texts_of(rng, 90)
    model = language_id.train([t for t, _ in rows], [x for _, x in rows])
    asked = [t for t, _ in texts_of(rng, 12)] + ["x" * 3000, "été", "one"]
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string")
    got = {r.doc_id: r for r in language_id.predict(df, model).collect()}
    for i, t in enumerate(asked):
        total, n = np.zeros(len(model.languages)), 0
        for w in t.lower().split():
            buckets = [*gram_buckets(w, (2, 3, 4), language_id.BITS), word_bucket(w, language_id.BITS)]
            total += sum(model.table[b].astype(np.float64) for b in buckets)
            n += len(buckets)
        z = (total / max(1, n) + model.bias) / model.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        assert abs(got[i].score - p.max()) < 1e-3 and got[i].lang_pred == model.languages[int(p.argmax())]


def test_texts_without_letters_are_und(spark):
    rng = np.random.default_rng(2)
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts_of(rng, 60))]
    odd = ["½ ²", "①", "12 34", "٣", "_ _", "😀", "²x", "中"]
    df = spark.createDataFrame([(f"k{i}", t, lang) for i, t, lang in rows] + [(f"odd{i}", t, None) for i, t in enumerate(odd)],
                               "doc_id string, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(df, F.lit(False)).collect()}
    for i, t in enumerate(odd):
        assert (got[f"odd{i}"].lang_pred == "und") == (not any(map(str.isalpha, t))), t
        assert got[f"odd{i}"].score > 0 or got[f"odd{i}"].lang_pred == "und"


def test_word_table_is_bounded_by_characters():
    table = common.WordTable(lambda ws: np.array([[len(w)] for w in ws], np.float32), 1)
    table.CHARS, table.PART = 5000, 1000
    seen = []
    table.compute = lambda ws: seen.append(sum(map(len, ws))) or np.array([[len(w)] for w in ws], np.float32)
    for k in range(40):
        words = [f"{k}{'a' * 900}", f"{k}b", "c" * 400]
        ids = table.ids(words)
        assert table.rows[ids, 0].tolist() == [len(w) for w in words]
        assert table.chars <= 5000 + 2000
    assert max(seen) <= 1000 + 903


# toxicity

def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def brute_logit(p, words):
    """One window, one word after the other."""
    x = []
    for raw in words:
        w = raw.lower().strip(toxicity.EDGE)
        grams = gram_buckets(w, (2, 3, 4, 5), toxicity.BITS)
        v = np.concatenate([p["word"][word_bucket(w, toxicity.BITS)], np.mean([p["char"][g] for g in grams], axis=0)])
        x.append(v @ p["in"] + p["in_b"])

    def gru(gates, u):
        h, out, n = np.zeros(toxicity.HIDDEN), [], toxicity.HIDDEN
        for g in gates:
            a = h @ u
            z, r = sigmoid(g[:n] + a[:n]), sigmoid(g[n:2 * n] + a[n:2 * n])
            c = np.tanh(g[2 * n:] + r * a[2 * n:])
            h = z * h + (1 - z) * c
            out.append(h)
        return out
    half = 3 * toxicity.HIDDEN
    h = np.concatenate([np.array(gru([g[:half] for g in x], p["uf"])), np.array(gru([g[half:] for g in x[::-1]], p["ub"]))[::-1]], axis=1)
    s = (np.tanh(h @ p["att"] + p["att_b"]) @ p["att_v"])[:, 0]
    a = np.exp(s - s.max())
    a /= a.sum()
    return float((a @ h) @ p["out"][:, 0] + p["out_b"][0])


def test_toxicity_scores_window_by_window(spark):
    rng = np.random.default_rng(3)
    rows = [(t, 0.0) for t, _ in texts_of(rng, 60)] + [(t, 1.0) for t, _ in texts_of(rng, 60, ("vile", "rotten"))]
    model = toxicity.train([t for t, _ in rows], np.array([y for _, y in rows]))
    asked = [t for t, _ in texts_of(rng, 8)] + [t for t, _ in texts_of(rng, 6, ("vile",))] + ["one", "Vile!", "a " * 100 + "rotten vile"]
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string")
    got = {r.doc_id: r.score for r in toxicity.predict(df, model).collect()}
    for i, t in enumerate(asked):
        words = t.split()
        starts = range(0, max(1, len(words) - (toxicity.WINDOW - toxicity.STRIDE)), toxicity.STRIDE)
        best = max(brute_logit(model.p, words[s:s + toxicity.WINDOW]) for s in starts)
        assert abs(got[i] - sigmoid(model.scale * best + model.shift)) < 1e-3
    long = spark.createDataFrame([(1, "x" * 400_000), (2, None)], "doc_id int, text string")
    assert all(0 <= r.score <= 1 for r in toxicity.predict(long, model).collect())


def test_every_short_passage_lies_in_a_window():
    for n in (1, 15, 33, 100, 1000):
        at = toxicity.windows(n)
        for size in (1, toxicity.WINDOW - toxicity.STRIDE):
            for s in range(max(1, n - size + 1)):
                want = set(range(s, min(n, s + size)))
                assert any(want <= set(w.tolist()) for w in at)


# quality

def brute_em(counts):
    """The stated votes model, pattern by pattern."""
    L = quality.LABELLERS
    patterns = sorted(c for c in counts if c != quality.NO_VOTES)
    votes = {c: [c // 3 ** i % 3 for i in range(L)] for c in patterns}
    kinds = list(quality.KINDS.values())
    order = (quality.BAD, quality.GOOD, quality.NONE)
    start = [[{quality.BAD: 0.02, quality.GOOD: 0.63, quality.NONE: 0.35} for _ in range(L)]]
    for known in kinds:
        start.append([{quality.BAD: 0.8, quality.GOOD: 0.05, quality.NONE: 0.15} if i in known
                      else {quality.BAD: 0.2, quality.GOOD: 0.4, quality.NONE: 0.4} for i in range(L)])
    prior = [0.8] + [0.2 / len(kinds)] * len(kinds)
    emit, share = [[dict(d) for d in e] for e in start], list(prior)
    post = {}
    for _ in range(300):
        new = {}
        for c in patterns:
            logs = [math.log(share[k]) + sum(math.log(emit[k][i][v]) for i, v in enumerate(votes[c])) for k in range(len(share))]
            top = max(logs)
            weights = [math.exp(x - top) for x in logs]
            new[c] = [w / sum(weights) for w in weights]
        for k in range(len(share)):
            mass = sum(counts[c] * new[c][k] for c in patterns)
            for i in range(L):
                for v in order:
                    hits = sum(counts[c] * new[c][k] for c in patterns if votes[c][i] == v)
                    emit[k][i][v] = (hits + 20 * start[k][i][v]) / (mass + 20)
        for k, known in enumerate(kinds, 1):
            for i in known:
                if emit[k][i][quality.BAD] < emit[k][i][quality.GOOD]:
                    emit[k][i][quality.BAD] = emit[k][i][quality.GOOD] = (emit[k][i][quality.BAD] + emit[k][i][quality.GOOD]) / 2
        n = sum(counts[c] for c in patterns)
        share = [(sum(counts[c] * new[c][k] for c in patterns) + 10 * prior[k]) / (n + 10) for k in range(len(share))]
        good = min(0.98, max(0.02, share[0]))
        rest = sum(share[1:])
        share = [good] + [s / rest * (1 - good) for s in share[1:]]
        done = post and max(abs(a - b) for c in patterns for a, b in zip(new[c], post[c])) < 1e-7
        post = new
        if done:
            break
    return {c: p[0] for c, p in post.items()}, share[0]


def test_weak_labels_against_plain_expectation_maximisation():
    rng = np.random.default_rng(5)
    counts = collections.Counter()
    for _ in range(600):
        kind = rng.choice([-1, -1, -1, 0, 1, 2, 3, 4])
        known = list(quality.KINDS.values())[kind] if kind >= 0 else ()
        votes = [quality.BAD if i in known and rng.random() < 0.8 else int(rng.choice([quality.BAD, quality.GOOD, quality.NONE], p=[0.05, 0.6, 0.35]))
                 for i in range(quality.LABELLERS)]
        counts[sum(v * 3 ** i for i, v in enumerate(votes))] += 1
    counts[quality.NO_VOTES] += 7
    found = quality.weak_labels(dict(counts))
    want, share = brute_em(counts)
    assert abs(found.share - share) < 1e-5
    assert all(abs(found.posterior[c] - p) < 1e-4 for c, p in want.items())


# decontamination

def planted_pair(rng, vocabulary, m):
    """Item and window of similarity 0.8 whose differing part is one shingle m times against another m times."""
    common_part = rng.choice(vocabulary, 8 * (m + 4) + 4).tolist()
    a, b = rng.choice(vocabulary, 2, replace=False)
    return common_part + [a] * (m + 4), common_part + [b] * (m + 4)


def test_pairs_with_repeated_shingles_are_found(spark):
    rng = np.random.default_rng(6)
    vocabulary = [f"w{i}" for i in range(4000)]
    items, docs = [], []
    for i in range(24):
        item, other = planted_pair(rng, vocabulary, int(rng.choice([5, 20, 30])))
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(rng.choice(vocabulary, 40).tolist() + other + rng.choice(vocabulary, 40).tolist())))
    d = spark.createDataFrame(docs, "doc_id int, text string")
    b = spark.createDataFrame([(f"i{i}", t) for i, t in items], "item_id string, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.matches(d, b).collect()}
    assert set(got) == {(i, f"i{i}") for i in range(24)}
    assert all(abs(s - 0.8) < 1e-9 for s in got.values())


def test_many_items_of_one_length(spark):
    """Two thousand items of thirty words: exact by an inverted index of our own; how selective and complete the index is."""
    rng = np.random.default_rng(7)
    vocabulary = np.array([f"w{i}" for i in range(500)])
    items = [rng.choice(vocabulary, 30).tolist() for _ in range(2000)]
    docs, planted = [], 0
    for i in range(150):
        w = rng.choice(vocabulary, 60).tolist()
        if i % 2 == 0:
            part = list(items[int(rng.integers(2000))])
            if i % 4 == 0:  # a word changed close to an end: 1 or 2 shingles of 26
                part[int(rng.choice([0, 1, 28, 29]))] = "other"
            w[20:20] = part
            planted += 1
        docs.append(w)
    where = collections.defaultdict(set)
    for j, it in enumerate(items):
        for s in range(26):
            where[tuple(it[s:s + 5])].add(j)
    want = set()
    for i, w in enumerate(docs):
        for s in range(len(w) - 29):
            sh = collections.Counter(tuple(w[s + k:s + k + 5]) for k in range(26))
            for j in set().union(*(where.get(x, ()) for x in sh)):
                other = collections.Counter(tuple(items[j][k:k + 5]) for k in range(26))
                low = sum((sh & other).values())
                if low >= 0.8 * (52 - low):
                    want.add((i, j))
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id int, text string")
    b = spark.createDataFrame([(j, " ".join(t)) for j, t in enumerate(items)], "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(d, b).collect()}
    assert got == want and len(got) >= planted
    # only windows with enough of the items' shingles are taken on: a few around each planted passage
    lengths = b.select(F.lit(30).alias("words"), F.explode(decontaminate.shingles(F.col("text"), 5)).alias("h")).distinct()
    windows = decontaminate.dense_windows(d, lengths, 0.8, 5)
    n = windows.count()
    assert n == windows.distinct().count() and planted <= n <= 7 * planted
    # the index: all pairs within the radius, and no other
    fps = [int(x) for x in rng.integers(-2**63, 2**63 - 1, 300)]
    near = []
    for f in fps:
        for k in (0, 10, 20, 24, 25):
            flip = sum(1 << int(x) for x in rng.choice(64, k, replace=False))
            near.append(((f & MASK) ^ flip))
    signed = [x - (1 << 64) if x >> 63 else x for x in near]
    w = spark.createDataFrame([(i, 30, x) for i, x in enumerate(signed)], "w int, words int, fp long")
    it = spark.createDataFrame([(j, 30, x) for j, x in enumerate(fps)], "item_id int, words int, fp long")
    pairs = [(r.w, r.item_id) for r in decontaminate.index_pairs(w, it).collect()]
    brute = {(i, j) for i, x in enumerate(near) for j, f in enumerate(fps) if ((f & MASK) ^ x).bit_count() <= 24}
    assert len(pairs) == len(set(pairs)) and set(pairs) == brute


def test_recall_of_the_radius_at_the_edge():
    """Fingerprints of shingle sets of similarity 0.8 without repeats: the share within the radius."""
    rng = np.random.default_rng(8)
    lost = 0
    for _ in range(4000):
        h = rng.integers(0, 2, (50, 64), dtype=np.int8)  # 40 common, 5 and 5 of their own
        a, b = h[:45], np.concatenate([h[:40], h[45:]])
        lost += int(((2 * a.sum(axis=0) > 45) != (2 * b.sum(axis=0) > 45)).sum() > decontaminate.RADIUS)
    assert lost <= 2


# digest index

def test_second_batch_shuffles_no_index_row_and_compaction(spark):
    def docs(a, b):
        return spark.range(a, b).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    index = exact_dedup.DigestIndex(spark, buckets=4)
    index.ingest(docs(0, 200), "a").count()
    groups = common.stored(docs(100, 300).select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")), "test-groups")
    for how, columns in (("left_anti", ()), ("inner", ("keep_id",))):
        plan = index.meeting(groups, how, *columns)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan
    index.ingest(docs(150, 400), "b").count()
    before = sorted(tuple(r) for r in spark.table(index.table).collect())
    index.compact()
    assert sorted(tuple(r) for r in spark.table(index.table).collect()) == before and len(before) == 400
    files = spark.read.parquet(index.entries_path).inputFiles()
    assert len(files) <= 4
    again = exact_dedup.DigestIndex(spark, index.path)
    assert again.entries_path == index.entries_path
    rows = again.ingest(docs(390, 410), "c")
    assert rows.filter("kept").count() == 10 and rows.count() == 20


# batches and ids

def test_batches_do_not_depend_on_the_session(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 1000 == 0, F.repeat(F.lit("x"), 1 << 24)).otherwise("y").alias("text")).coalesce(1)
    plan = common.mapped(rows, lambda b: {"n": [b.num_rows], "size": [max(1, b.column("text").nbytes)]}, "n long, size long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for value in ("100000", "10"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", value)
            got = plan.collect()
            assert sum(r.n for r in got) == 3000 and max(r.n for r in got) <= common.BATCH_ROWS
        simhash_dedup.near_duplicates(rows.filter("doc_id % 1000 > 990")).count()
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10"
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    parts = list(common.cut_batches([pa.RecordBatch.from_pydict({"t": ["a" * 10, None, "b" * 50, "c" * 5, "d"]})], rows=2, size=20))
    assert [p.num_rows for p in parts] == [2, 1, 2]


def test_text_ids_keep_their_type(spark):
    df = spark.createDataFrame([(k, t) for k, t in (("a", "One two three. Four five six seven eight nine ten."), ("b", "One two three. Four five six seven eight nine ten."),
                                                    ("x9", "Something else altogether here."), (None, ""))], "doc_id string, text string")
    near = {r.doc_id: r.component_id for r in simhash_dedup.near_duplicates(df).collect()}
    assert near["b"] == "a" and near["x9"] == "x9"
    assert {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(df).collect()} == {"a": 0, "b": 2, "x9": 0, None: 0}
    assert {r.doc_id for r in quality.score_quality(df).collect()} == {"a", "b", "x9", None}
    b = spark.createDataFrame([], "item_id string, text string")
    none = decontaminate.matches(df, b)
    assert none.count() == 0 and dict(none.dtypes)["item_id"] == "string" and dict(none.dtypes)["doc_id"] == "string"


def test_cut_marks_agree_with_the_stated_ends():
    import random
    rnd = random.Random(1)
    letters = list("ab.!?。！」”।\n\r\t  \x0b　")
    for _ in range(20_000):
        t = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14)))
        assert substring_dedup.pieces(t) == [p for p in re.sub(substring_dedup.ENDS, "\\1\0", t).split("\0") if p]
    texts = ["One. Two. Three. Four.", "", "Two. Three. x", "One. Two. Three. Four."]
    who, pos, size, h1, h2 = substring_dedup.runs(texts, 2, 1)
    by = collections.defaultdict(set)
    for w, p, n, a, b in zip(who, pos, size, h1, h2):
        by[a, b].add(" ".join(substring_dedup.normalised(texts[w])[p:p + n]))
    assert all(len(x) == 1 for x in by.values()) and len(by) == 4
