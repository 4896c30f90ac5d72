"""The training-data operators against brute force, round trips, held-out accuracy and edge cases."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import oracle_check as O
from listinglake.llm import (chat_format, common, components, decontaminate, exact_dedup, language_id, mixing, quality,
                             simhash_dedup, substring_dedup, token_counts, toxicity)
from listinglake.llm.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# an operator's own names as extra columns
EXTRA = ["kept", "keep_id", "digest", "fp", "component_id", "_th", "_doc", "n", "starts", "score", "copy_no", "code", "sh", "lang", "source"]
DOCS = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in EXTRA)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *[f"{c}{j}" for c in EXTRA[:-2]], "en", "s") for j, (i, t) in enumerate(rows)], DOCS)


def edges(spark):
    words = " ".join(f"Word{i % 50} other{i % 7}, and then." for i in range(4000))
    rows = [(1, None), (None, None), (2, ""), (3, "  \n\t"), (4, "One two. Three four!"), (4, "One two. Three four!"),
            (5, "one  two. three\tfour!"), (None, "One two. Three four!"), (6, words), (7, words + " end"), (8, "é" * 5000),
            (9, "\x01\x02 odd \x01 bytes. Next one here. And so on."), (10, "a b c"), (10, "x y z"), (11, "12 34"), (12, "#### $$$$ !!!!")]
    return frame(spark, rows)


def empty(spark):
    return frame(spark, [])


def group_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op9_mix_sources", "op10_chat_format"])
def test_against_sql(spark, name):
    r = O.check(spark, name, SMALL)
    assert r["cols_match"] and r["rows_match"] and r["hash_match"], r


# exact dedup

def test_exact_edges(spark):
    rows = exact_dedup.DigestIndex(spark, buckets=3).ingest(edges(spark)).collect()
    assert len(rows) == 16
    by = collections.defaultdict(list)
    for r in rows:
        by[r.digest].append(r)
    blank = by[hashlib.sha256(b"").digest()]
    assert {r.keep_id for r in blank} == {3} and blank[0].group_size == 4 and sum(r.kept for r in blank) == 1
    same = by[hashlib.sha256(b"Onetwo.Threefour!").digest()]
    assert {r.keep_id for r in same} == {4} and len(same) == 3 and sum(r.kept for r in same) == 1
    assert all(sum(r.kept for r in g) == 1 for g in by.values())
    assert exact_dedup.DigestIndex(spark).ingest(empty(spark)).count() == 0
    stay = exact_dedup.exact_dedup(edges(spark))
    assert stay.columns == edges(spark).columns and stay.count() == len(by)


def test_exact_index_grows_and_persists(spark):
    first = exact_dedup.DigestIndex(spark, buckets=3)
    a = first.ingest(frame(spark, [(1, "a b"), (2, "c")]), "one")
    assert a.filter("kept").count() == 2
    again = exact_dedup.DigestIndex(spark, first.path)
    assert again.buckets == 3
    b = {r.doc_id: r for r in again.ingest(frame(spark, [(3, "a  b"), (4, "d")]), "two").collect()}
    assert not b[3].kept and b[3].keep_id == 1 and b[4].kept
    assert again.ingest(frame(spark, [(3, "a  b"), (4, "d")]), "two").filter("kept").count() == 1  # a replay
    assert spark.read.parquet(first.entries_path).count() == 3


def test_exact_anti_join_reads_the_index_bucketed(spark):
    index = exact_dedup.DigestIndex(spark, buckets=3)
    index.ingest(frame(spark, [(1, "a")]))
    new = exact_dedup.digests(frame(spark, [(2, "b")])).hint("merge").join(spark.table(index.table).select("digest").hint("merge"), "digest", "left_anti")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan and plan.count("Exchange") == 1, plan


# near-dedup

def brute_fingerprint(text, k=4):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) if w]
    sh = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    out = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    return out - (1 << 64) if out >> 63 else out


def brute_near(rows, d=4):
    fps = {i: brute_fingerprint(t) & (1 << 64) - 1 for i, t in rows}
    ids = sorted(fps)
    pairs = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if (fps[a] ^ fps[b]).bit_count() <= d]
    return fps, group_of(pairs, ids)


def test_simhash_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows += [(100_000, None), (100_001, ""), (100_002, "Two words"), (100_003, "two WORDS"), (100_004, "a b c d e"), (100_005, "É b c d")]
    fps, root = brute_near(rows)
    got = {r.doc_id: r for r in simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: r.fp & (1 << 64) - 1 for i, r in got.items()} == fps
    assert {i: r.component_id for i, r in got.items()} == root


@pytest.mark.parametrize("block,sample,d", [(2048, 64, 4), (8, 1, 4), (16, 1, 2), (8, 1, 1), (8, 2, 6)])
def test_links_span_all_groups(spark, block, sample, d):
    rng = np.random.default_rng(1)
    near = [int(x) for c in rng.integers(0, 1 << 63, 6, dtype=np.uint64) for x in
            [c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(0, d + 2), dtype=np.uint64), initial=np.uint64(0)) for _ in range(60)]]
    fps = sorted({x - (1 << 64) if x >> 63 else x for x in [*near, *map(int, rng.integers(0, 1 << 63, 200, dtype=np.uint64))]})
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    found = simhash_dedup.links(df, d, block, sample).collect()
    mask = (1 << 64) - 1
    truth = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & mask).bit_count() <= d]
    assert group_of([(r.u, r.v) for r in found], fps) == group_of(truth, fps)
    labels = {r.node: r.label for r in components.components(simhash_dedup.links(df, d, block, sample)).collect()}
    assert {x: labels.get(x, x) for x in fps} == group_of(truth, fps)


def test_simhash_edges(spark):
    assert simhash_dedup.near_duplicates(edges(spark)).count() == 16
    assert simhash_dedup.near_duplicates(empty(spark)).count() == 0
    out = simhash_dedup.simhash_dedup(edges(spark))
    rows = simhash_dedup.near_duplicates(edges(spark))
    assert out.columns == edges(spark).columns and out.count() == rows.select("component").distinct().count()
    assert simhash_dedup.near_duplicates(frame(spark, [(None, "a"), (None, "a")])).filter("component_id is null").count() == 2


# substring dedup

def brute_pieces(text):
    return [p for p in re.sub(substring_dedup.ENDS, "\\1\0", text).split("\0") if p]


def brute_substring(rows, run, least):
    runs, norm = collections.defaultdict(list), {}
    for i, t in rows:
        ps = [re.sub(r"[\x09-\x0D]", " ", p).strip(" ").lower() for p in brute_pieces(t or "")]
        for k in range(len(ps) - run + 1):
            if sum(p.count(" ") + 1 for p in ps[k:k + run]) >= least:
                runs[tuple(ps[k:k + run])].append((i, k))
    gone = collections.defaultdict(set)
    for places in runs.values():
        for i, k in sorted(places)[1:]:
            gone[i] |= set(range(k, k + run))
    return {i: ("".join(p for k, p in enumerate(brute_pieces(t or "")) if k not in gone[i]), sorted(gone[i])) for i, t in rows}


@pytest.mark.parametrize("run,least", [(2, 10), (3, 1)])
def test_substring_against_brute_force(spark, run, least):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    passage = "The first part of it is here now. A second sentence goes on for a while! Does the third one ask? It does."
    rows += [(200_000, f"Alone. {passage} Other end."), (200_001, f"Before this. {passage}\nMore."), (200_002, f"x {passage} y")]
    got = {r.doc_id: (r.text, r.removed) for r in substring_dedup.substring_dedup(
        spark.createDataFrame(rows, "doc_id bigint, text string"), run, least).collect()}
    assert got == brute_substring(rows, run, least)
    assert "second sentence" in got[200_000][0] and "second sentence" not in got[200_001][0] + got[200_002][0]


def brute_spans(texts):
    """Removed sentences of the registered query: any run of sentences that is shortest from its first or up to its last one."""
    runs, gone = collections.defaultdict(list), {i: set() for i, _ in texts}
    for i, t in texts:
        ps = [re.sub(r"[\x09-\x0D]", " ", p).strip(" ").lower() for p in brute_pieces(t or "")]
        words = [p.count(" ") + max(1, len(re.findall(f"[{substring_dedup.UNSPACED}]", p))) for p in ps]
        n, found = len(ps), set()
        for k in range(n):
            found |= {(k, e) for e in [next((e for e in range(k + 2, n + 1) if sum(words[k:e]) >= 10), None)] if e}
            found |= {(b, k + 1) for b in [next((b for b in range(k - 1, -1, -1) if sum(words[b:k + 1]) >= 10), None)] if b is not None}
        if not found and any(ps):
            found = {(0, n)}
        for a, e in found:
            runs[tuple(ps[a:e])].append((i, a))
    for key, places in runs.items():
        for i, a in sorted(places)[1:]:
            gone[i] |= set(range(a, a + len(key)))
    return {i: sorted(g) for i, g in gone.items()}


def test_substring_short_sentences(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    menu = "\n".join(f"item {k}" for k in range(40, 52)) + "\nThe long line of the menu has eleven words or more in it.\nSoup.\nBread.\nTea."
    han = "今天天气很好\n我们去公园\n然后回家吃饭"
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [
        (200_000, f"One begins.\n{menu}\nOne ends here."), (200_001, f"Two begins?\n{menu}\nTwo ends."), (200_002, f"Three begins!\n{menu}"),
        (200_003, f"开始\n{han}\n第一个结尾"), (200_004, f"另一个\n{han}\n第二个结束了"), (200_005, "Ja. Nein."), (200_006, "Ja. Nein."), (200_007, "Ja. Nein. Other words follow.")]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: r.removed for i, r in got.items()} == brute_spans(rows)
    assert got[200_000].n_removed == 0 and got[200_001].text == "Two begins?\nTwo ends." and got[200_002].text == "Three begins!\n"
    assert got[200_003].n_removed == 0 and got[200_004].text == "另一个\n第二个结束了"
    assert [got[i].n_removed for i in (200_005, 200_006, 200_007)] == [0, 2, 0]


def test_substring_texts_of_one_piece_and_other_scripts(spark):
    line = " ".join(f"w{k}" for k in range(60))
    passages = ["今天天气很好。我们去公园！然后回家吃饭？", "यह पहला वाक्य बहुत लंबा है।यह दूसरा वाक्य भी काफ़ी लंबा है।", "هل هذا هو السؤال الأول هنا؟هذه هي الجملة الثانية في النص۔"]
    rows = [(1, line), (2, line + "\n"), (3, line + " w60"), (4, " \n"), (5, " \n"), (6, "今日は「休み。」明日は仕事。"), (7, "今日は「休み。」明日は仕事。")]
    for k, p in enumerate(passages):
        rows += [(10 + 2 * k, f"一。{p}二"), (11 + 2 * k, f"三。{p}四")]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: r.removed for i, r in got.items()} == brute_spans(rows)
    assert got[1].text == line and got[2].text == "" and got[3].n_removed == 0 and got[5].text == " \n"
    assert got[6].n_sentences == 2 and got[6].n_removed == 0 and got[7].text == ""
    for k, p in enumerate(passages):
        assert got[10 + 2 * k].n_removed == 0 and got[11 + 2 * k].text == "三。四"


def test_substring_edges(spark):
    out = {(r.doc_id, r.n_sentences): r for r in substring_dedup.substring_dedup(edges(spark)).collect()}
    assert out[9, 3].text == "\x01\x02 odd \x01 bytes. Next one here. And so on."
    assert out[1, 0].text == "" and substring_dedup.substring_dedup(edges(spark)).count() == 16
    assert substring_dedup.substring_dedup(empty(spark)).count() == 0


# classifiers

def test_language_held_out(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op4_language_id"](spark, MEDIUM).join(docs, "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    wrong = [r for r in rows if r.accepted and r.lang != r.lang_pred]
    assert len(wrong) <= 0.03 * len(rows)


def test_language_edges(spark):
    known = language_id.train(["the and of"] * 30 + ["der die das"] * 30, ["en"] * 30 + ["de"] * 30)
    got = {(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(edges(spark), known).collect()}
    assert (1, "und", 0.0) in got and (11, "und", 0.0) in got and (12, "und", 0.0) in got and len(got) >= 13
    assert {r.lang_pred for r in language_id.identify(edges(spark), F.lit(True)).collect()} == {"und"}
    assert language_id.identify(empty(spark), F.lit(False)).count() == 0


def test_toxicity_gradients():
    """Backward pass against finite differences."""
    rng, m = np.random.default_rng(0), toxicity.Model()
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    places = toxicity.windows(40)
    gates = rng.standard_normal((40, 6 * toxicity.HIDDEN))
    cache = {}
    m.forward(np.concatenate([gates, gates[:1]]), places, cache)
    grad, d_gates = m.backward(np.ones(len(places)), cache, 40)

    def total():
        return float(m.forward(np.concatenate([gates, gates[:1]]), places, {}).astype(np.float64).sum())
    for name in ("uf", "ub", "att", "att_v", "out"):
        at = (1, 0)
        for step in (1e-2,):
            m.p[name][at] += step
            up = total()
            m.p[name][at] -= 2 * step
            down = total()
            m.p[name][at] += step
        assert abs((up - down) / (2 * step) - grad[name][at]) < 2e-2 * max(1, abs(grad[name][at])), name
    gates[5, 3] += 1e-2
    up = total()
    gates[5, 3] -= 2e-2
    assert abs((up - total()) / 2e-2 - d_gates[5, 3]) < 2e-2


def test_toxicity_learns_and_edges(spark):
    rng = np.random.default_rng(2)
    plain = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed", "do"]
    rows, labels = [], []
    for i in range(300):
        w = rng.choice(plain, rng.integers(20, 90)).tolist()
        if i % 3 == 0:
            for _ in range(3):
                w[rng.integers(0, len(w))] = "idiot"
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 3 == 0)))
    docs, lab = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    held = common.crc_mod("doc_id", 5) == 0
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, lab, held).collect()}
    test = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 3 == 0) for i in test]) > 0.9
    none = lab.filter("false")
    assert {r.score for r in toxicity.score_toxicity(edges(spark), none, held).collect()} == {0.0}
    model = toxicity.train([t for _, t in rows[:60]], np.array([t for _, t in labels[:60]], float))
    out = toxicity.predict(edges(spark), model).collect()
    assert len(out) == 16 and all(0 <= r.score <= 1 for r in out)
    assert toxicity.predict(empty(spark), model).count() == 0


def test_quality(spark):
    lab = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op6_quality"](spark, MEDIUM).join(lab, "doc_id").collect()
    good, bad = [r.keep for r in rows if r.quality == 1], [r.keep for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.6
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    # the spread-out job against the same model applied here, row by row
    model = quality.learn(docs)[0]
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)
    direct = dict(zip(ids, model.scores([texts[i] or "" for i in ids], model.words())))
    got = {r.doc_id: r.score for r in quality.score_quality(docs).collect()}
    assert max(abs(direct[i] - got[i]) for i in ids) < 1e-6
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {i for i in ids if direct[i] >= quality.KEEP_FROM}


def test_quality_rejects_every_kind(spark):
    lab = spark.read.parquet(f"{MEDIUM}/labels.parquet").filter("quality = 0").select("doc_id")
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    kept = collections.defaultdict(list)
    for r in quality.score_quality(docs).join(lab, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect():
        words = (r.text or "").split()
        if len(words) >= quality.SHORT:
            kind = "repeats" if quality.repeats(words) > len(words) / 2 else "tables" if words.count("|") > len(words) / 20 else "symbols"
            kept[kind].append(r.keep)
    assert set(kept) == {"repeats", "tables", "symbols"} and all(np.mean(k) < 0.2 for k in kept.values()), kept


def test_quality_edges(spark):
    out = quality.keep_good(edges(spark))
    assert out.columns == edges(spark).columns and out.count() <= 16
    assert quality.score_quality(empty(spark)).count() == 0 and quality.keep_good(empty(spark)).count() == 0


# tokens

def test_tokens_against_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    odd = ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "  two  spaces \n\n\t x ", "it's we'll I'D", "ünïcödé 漢字 かな 😀👍🏽",
           "a" * 5000, "ab" * 3000, "\x1c\x1d\x85\u00a0\u2028 x", "123456 7.8%", "é" * 300, "=" * 257 + "x", "\x00\x01 ctrl", "\u200b zero"]
    rng = np.random.default_rng(3)
    odd += ["".join(chr(c) for c in rng.choice([32, 10, 39, 65, 97, 115, 49, 0xE9, 0x4E00, 0x1F600, 0x3000, 9], 200)) for _ in range(40)]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + [(-i, t) for i, t in enumerate(odd, 1)] + [(-99, None)]
    got = {r.doc_id: r for r in token_counts.token_counts(spark.createDataFrame(rows, "doc_id bigint, text string"), path, public_tokenizers.PATTERN).collect()}
    want = {i: len(e.ids) for (i, _), e in zip(rows, lib.encode_batch([t or "" for _, t in rows], add_special_tokens=False))}
    assert {i: r.n_tokens for i, r in got.items()} == want
    assert all(got[i].n_bytes == len((t or "").encode()) and got[i].over_limit == (want[i] > 512) for i, t in rows)


def test_token_proof_and_edges(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    c, lib = token_counts.counter(path, public_tokenizers.PATTERN), Tokenizer.from_file(path)
    words = sorted(c.whole)[::200]
    assert len(c.whole) > 40_000 and all(len(lib.encode(w, add_special_tokens=False).ids) == 1 for w in words)
    assert token_counts.token_counts(edges(spark), path, public_tokenizers.PATTERN).count() == 16
    assert token_counts.token_counts(empty(spark), path, public_tokenizers.PATTERN).count() == 0


# decontamination

def brute_matches(docs, items, similarity=0.8, k=5):
    def words(t):
        return [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    out = set()
    for j, it in items:
        iw = words(it)
        n = min(k, len(iw))
        if not n:
            continue
        ic = collections.Counter(tuple(iw[i:i + n]) for i in range(len(iw) - n + 1))
        for d, t in docs:
            w = words(t)
            for s in range(max(1, len(w) - len(iw) + 1)):
                x = w[s:s + len(iw)]
                c = collections.Counter(tuple(x[i:i + n]) for i in range(len(x) - n + 1))
                low, high = sum((c & ic).values()), sum((c | ic).values())
                if low and low >= similarity * high:
                    out.add((d, j))
    return out


def test_matches_against_brute_force(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary, n))) for i, n in enumerate([40, 25, 12, 60, 3, 1, 33])] + [(7, None), (8, ""), (9, "a a a a a a a a a a")]
    docs = []
    for i in range(120):
        w = rng.choice(vocabulary, 150).tolist()
        t = items[i % 7][1].split()
        if i % 3 == 0:
            cut = int(rng.integers(0, 4))
            t = t[cut:] if i % 2 else t[:len(t) - cut]
            w[70:70] = [x.upper() + "," for x in t]
        if i % 5 == 0 and len(t) > 20:
            t = t[:]
            t[10] = "changed"
            w[20:20] = t
        docs.append((i, " ".join(w)))
    docs += [(200, None), (201, ""), (202, items[1][1]), (203, "a a a a a a a a a a a a"), (None, items[0][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.matches(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute_matches(docs, items)
    assert decontaminate.matches(d.filter("false"), b).count() == 0 and decontaminate.matches(d, b.filter("false")).count() == 0
    leaks = {i for i, _ in brute_matches(docs, items)}
    assert {r.doc_id for r in decontaminate.decontaminate(d, b).collect()} == {i for i, _ in docs} - leaks
    out = decontaminate.decontaminate(edges(spark), b)
    assert out.columns == edges(spark).columns and out.count() == 16


@pytest.mark.parametrize("name", ["op8_decontaminate", "op10_chat_format"])
def test_native(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# mixing

def test_mixing(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("0123456789").alias("text"),
                                      F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").alias("source"))
    out = mixing.mix_sources(docs, {"big": 1, "mid": 1, None: 2}, total_chars=200_000)
    n = {r.source: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(n["big"] - 5000) < 300 and abs(n["mid"] - 5000) < 300 and abs(n[None] - 10_000) < 500
    again = mixing.mix_sources(docs, {"big": 1, "mid": 1, None: 2}, total_chars=200_000)
    assert out.exceptAll(again).count() == 0 and out.columns == ["doc_id", "text", "source", "copy"]
    assert set(mixing.mix_sources(docs, {"mid": 1}).select("source").distinct().toPandas().source) == {"mid"}
    many = mixing.mix_sources(docs.limit(3), {"big": 1}, total_chars=60_000)  # a rate of 2,000
    assert abs(many.count() - 6000) < 500
    first = [r.doc_id for r in out.limit(1000).collect()]
    assert first != sorted(first)


def test_mixing_edges(spark):
    out = mixing.mix_sources(edges(spark))
    assert out.columns == [*edges(spark).columns, "copy"] and out.count() >= 0
    assert mixing.mix_sources(empty(spark)).count() == 0


# chat

def test_layouts_and_round_trip(spark):
    nasty = [r"\### Assistant: </turn> ok", "### a: b</turn>\n", "\\t \\b \\h \\c", "</tu</turn>rn>", "#### x", "", "\\", "</turn", "é😀: ###"]
    records, want = [], {}

    def add(i, body, turns):
        records.append((i, __import__("json").dumps(body)))
        want[i] = [(r, t or "") for r, t in turns]
    for i, t in enumerate(nasty):
        add(i, {"messages": [{"role": "user", "content": t}, {"role": "assistant", "content": t}], "id": 3}, [("user", t), ("assistant", t)])
    add(50, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")])
    add(51, {"instruction": "do", "input": "", "output": "x", "score": [1, {"k": 2}]}, [("user", "do"), ("assistant", "x")])
    add(52, {"instruction": "do", "input": "this", "output": "x"}, [("user", "do\n\nthis"), ("assistant", "x")])
    add(53, {"system": "s", "prompt": "p", "completion": None}, [("system", "s"), ("user", "p"), ("assistant", "")])
    add(54, {"question": "p", "answer": "r"}, [("user", "p"), ("assistant", "r")])
    records += [(60, '{"foo": 1}'), (61, "not json"), (62, None), (63, "{}")]
    df = spark.createDataFrame(records, "conv_id bigint, j string").select("conv_id", F.try_parse_json("j").alias("record"))
    done = chat_format.format_conversations(chat_format.canonical_turns(df))
    back = {r.conv_id: r for r in chat_format.read_back(done).collect()}
    assert {i: [(t.role, t.text) for t in r.turns] for i, r in back.items()} == want
    assert all(r.loss_text == "".join(t for role, t in want[i] if role == "assistant") for i, r in back.items())
    assert all(r.formatted.count("</turn>") == len(want[i]) for i, r in back.items())
    assert {r.conv_id for r in chat_format.unmapped(df).collect()} == {60, 61, 62, 63}


def test_chat_edges(spark):
    rows = [(None, 0, "user", "a"), (None, None, None, None), (5, 1, "assistant", "x" * 200_000), (5, 0, "user", ""), (5, 1, "assistant", "x"), (5, 1, "assistant", "x"),
            (6, 0, "a: b", "</turn>")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")
    rec = df.select("conv_id", F.call_function("to_variant_object", F.struct("turn", "role", "text")).alias("record"))
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.read_back(chat_format.format_conversations(chat_format.canonical_turns(rec))).collect()}
    assert back[None] == [("", ""), ("user", "a")] and back[6] == [("a: b", "</turn>")]
    assert [t[:5] for _, t in back[5]] == ["", "x", "x", "xxxxx"]
    assert chat_format.format_conversations(chat_format.canonical_turns(rec.filter("false"))).count() == 0


# pipeline

def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality classifier", "exact dedup", "simhash near-dedup", "benchmark decontamination", "mixing to target weights"]
    at = common.stored(steps["quality classifier"](spark, docs, SMALL), "t")
    model = quality.learn(docs)[0]
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    good = [x for x, s in zip(texts, model.scores([t or "" for _, t in texts], model.words())) if s >= quality.KEEP_FROM]
    assert {r.doc_id for r in at.collect()} == {i for i, _ in good}
    at = common.stored(steps["exact dedup"](spark, at, SMALL), "t")
    best = {}
    for i, t in good:
        key, rank = re.sub(r"[\x20\x09-\x0D]", "", t or ""), (-len(t or ""), i)
        best[key] = min(best.get(key, rank), rank)
    kept = {r[1] for r in best.values()}
    assert {r.doc_id for r in at.collect()} == kept
    at = common.stored(steps["simhash near-dedup"](spark, at, SMALL), "t")
    root = brute_near([x for x in good if x[0] in kept])[1]
    kept = set(root.values())
    assert {r.doc_id for r in at.collect()} == kept
    at = common.stored(steps["benchmark decontamination"](spark, at, SMALL), "t")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept -= {i for i, _ in brute_matches([x for x in good if x[0] in kept], items)}
    assert {r.doc_id for r in at.collect()} == kept and at.columns == docs.columns
    out = steps["mixing to target weights"](spark, at, SMALL)
    assert {r.doc_id for r in out.collect()} <= kept and out.columns == [*docs.columns, "copy"]
    assert corpus_pipeline.run(spark, SMALL).count() == out.count()


def test_stages_on_edges(spark, tmp_dir):
    d = f"{tmp_dir}/t"
    spark.createDataFrame([(1, "some item text that is long enough here")], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    for docs in (edges(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = common.stored(stage(spark, docs, d), "t")
        assert docs.columns == [*edges(spark).columns, "copy"]
