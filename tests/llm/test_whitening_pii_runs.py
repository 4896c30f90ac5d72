"""Embedding whitening, personal data and periodic runs against brute force, with edge cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from listinglake.llm import periodic_runs, personal_data, whitening
from listinglake.llm.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# periodic runs

def brute_runs(words, least=12):
    """Every run by comparing each word with the one a period further on."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            e = i
            while e + p < n and words[e] == words[e + p]:
                e += 1
            if e - i + p >= max(least, 2 * p):
                found.setdefault((i, e - i + p), p)
            i = max(e, i + 1)
    return sorted((s, p, length) for (s, length), p in found.items())


def brute_row(doc_id, text):
    words = SPACE.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = set()
    for s, p, length in runs:
        gone.update(range(s + p, s + length))
    best = min(((-length, s, p) for s, p, length in runs), default=None)
    lines = "".join(f"{s},{length},{p}\n" for s, p, length in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    four = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, sha(lines), sha(kept))


def test_runs_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SMALL).collect())
    assert got == sorted(brute_row(*d) for d in docs)
    assert sum(r[1] > 0 for r in got) > 10


@pytest.mark.parametrize("seed", range(6))
def test_runs_random_words(seed):
    rnd = np.random.default_rng(seed)
    for _ in range(60):
        documents, plain, base = [], [], 0
        for _ in range(rnd.integers(1, 6)):
            n = int(rnd.choice([0, 1, 2, 11, 12, 13, 40, 100, 300]))
            w = rnd.integers(0, rnd.choice([1, 2, 3, 10]), n)
            if rnd.random() < 0.5 and n > 20:  # a planted period
                a = int(rnd.integers(0, n))
                p = int(rnd.integers(1, max(2, (n - a) // 2 + 1)))
                w = np.array([w[i] if i < a else w[a + (i - a) % p] for i in range(n)])
            plain.append(w.tolist())
            documents.append(w.astype(np.int64) + base)
            base += 20
        least = int(rnd.choice([2, 3, 5, 12]))
        got = periodic_runs.runs_of(documents, least)
        for w, g in zip(plain, got):
            assert [(s, p, length) for s, length, p in g.tolist()] == brute_runs(w, least)


def test_lce_against_comparison():
    rnd = np.random.default_rng(3)
    for words in (rnd.integers(0, 2, 700), np.zeros(500, np.int64), np.tile(rnd.integers(0, 3, 70), 9)):
        lce = periodic_runs.CoverLce(words)
        i, j = np.sort(rnd.integers(0, len(words), (2, 3000)), axis=0)
        i, j = i[i < j], j[i < j]
        for a, b, n in zip(i, j, lce(i, j)):
            k = 0
            while b + k < len(words) and words[a + k] == words[b + k]:
                k += 1
            assert n == k


def test_runs_edges(spark):
    word = "x" * 50_000
    rows = [(1, None), (None, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a " * 11), (5, "a " * 12), (5, "a " * 12),
            (None, "b c " * 9), (6, "a b　c d " * 12), (7, " ".join([word] * 14)), (8, "a b c d e f g h i j k l m n"),
            (9, "a b a b a b a b a b a b x y z x y z x y z x y z x y z")]
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], "doc_id bigint, text string, runs string, n_words int")
    got = {(r.doc_id, r.text): r for r in periodic_runs.periodic_runs(docs).collect()}
    assert periodic_runs.periodic_runs(docs).count() == 12
    assert got[4, " ".join("a" * 11)].runs == []
    assert [tuple(x) for x in got[5, "a"].runs] == [(0, 12, 1)]
    assert [tuple(x) for x in got[None, "b c"].runs] == [(0, 18, 2)]
    assert [tuple(x) for x in got[6, "a b　c d"].runs] == [(0, 24, 2)]
    assert got[7, word].n_words == 14
    assert [tuple(x) for x in got[9, "a b x y z"].runs] == [(0, 12, 2), (12, 15, 3)]
    assert periodic_runs.run_digests(docs.filter("false"), plant=True).count() == 0
    planted = {r.doc_id: tuple(r) for r in periodic_runs.run_digests(docs.filter("doc_id is not null"), plant=True).collect()}
    for i, t in rows:
        if i is not None:
            assert planted[i] == brute_row(i, t)


# embedding whitening

def brute_whitening(rows, most=16):
    usable = {}
    for i, v in rows:
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v):
            usable.setdefault(tuple(math.floor(64 * c) + 1_000_000 for c in v), []).append(i)
    n = len(usable)
    x = np.array(list(usable), dtype=object)
    total = x.sum(axis=0)
    y = ((x * n - total) / n).astype(np.float64)
    cov = np.einsum("ni,nj->ij", y, y) / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return usable, n, total, values, axes, np.trace(cov), y


def test_whitening_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    usable, n, total, values, axes, trace, y = brute_whitening(rows)
    got = collections.defaultdict(dict)
    for r in QUERIES["op11_embedding_whitening"](spark, MEDIUM).collect():
        got[r.vec_id][r.component] = r
    assert len(got) == len(rows)
    signs = {}
    for k, (x, ids) in enumerate(usable.items()):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, total))
        for i in ids:
            for c in range(16):
                r = got[i][c + 1]
                want = float(y[k] @ axes[:, c]) / math.sqrt(values[c])
                sign = signs.setdefault(c, 1 if abs(r.whitened - want) < abs(r.whitened + want) else -1)
                assert abs(r.whitened - sign * want) < 1e-8
                assert (r.n, r.deviation) == (n, deviation) and abs(r.explained - values[c] / trace) < 1e-9
                assert r.identity_error < 1e-9


def test_whitening_copies_weights_and_edges(spark):
    rnd = np.random.default_rng(2)
    vectors = rnd.normal(size=(40, 5))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(100 + i, vectors[0].tolist()) for i in range(60)]
    rows += [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [float("nan")] * 5), (204, [float("inf")] * 5),
             (205, [1.0, 2.0]), (None, vectors[1].tolist()), (None, vectors[1].tolist())]
    df = spark.createDataFrame([(i, v, "e", 1) for i, v in rows], "vec_id bigint, embedding array<double>, copies string, h1 int")
    got = whitening.whiten(df, components=3).collect()
    assert len(got) == (40 + 60 + 2) * 3 and {r.n for r in got} == {40}
    assert {r.copies for r in got if r.vec_id == 0} == {61} and {r.copies for r in got if r.vec_id is None} == {3}
    assert len({(r.component, r.whitened) for r in got if r.vec_id == 0 or (r.vec_id or 0) >= 100}) == 3  # once for each distinct vector
    weighted = {(r.vec_id, r.component): r for r in whitening.whiten(df, components=5, weights="count").collect() if r.vec_id is not None}
    grid = np.floor(64 * vectors) + 1_000_000
    w = np.array([61, 3] + [1] * 38)
    y = grid - (grid * w[:, None]).sum(axis=0) / w.sum()
    cov = (y * w[:, None]).T @ y / w.sum()
    values, axes = np.linalg.eigh(cov)
    for c in range(5):
        want = y @ axes[:, 4 - c] / math.sqrt(values[4 - c])
        have = np.array([weighted[i, c + 1].whitened for i in range(40)])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-8
    assert next(iter(weighted.values())).n == 102 and next(iter(weighted.values())).identity_error < 1e-9
    assert whitening.whiten(df.filter("false")).collect() == []
    assert whitening.whiten(df.filter("vec_id = 0 or vec_id >= 100")).collect() == []  # one distinct vector: no variance
    flat = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(9)], "vec_id int, embedding array<float>")
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}  # a constant dimension has no component
    far = spark.createDataFrame([(i, [1e300 * (-1) ** i, float(i)]) for i in range(6)], "vec_id int, embedding array<double>")
    assert {r.component for r in whitening.whiten(far).collect()} <= {1, 2}


# personal data

NAIVE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def naive_spans(text):
    """The four patterns as the contract writes them."""
    out = []
    for kind, pattern in NAIVE.items():
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                double = sum(d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for k, d in enumerate(digits[::-1]))
                if not 13 <= len(digits) <= 19 or double % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_against_the_patterns():
    rnd = np.random.default_rng(4)
    odd = ["a@b.c+d@e.f", "a@b@c.de", "@b.c", "a@b", "a@b.c.@d.e", "x..y@-a-.b", "1.2.3.4.5.6.7.8", "1.2.3.256", "001.02.3.4", "1.2.3",
           "4111 1111 1111 1111", "4111-1111-1111-1111 2", "4111  1111", "+1 (988) 555-2485", "+12", "+1+2345678901", "+1 ((((", "é@b.c", "a@b.c٠"]
    alphabet = list("abA0123456789") * 2 + list(".@+- ()%_\n\tñ")
    texts = odd + ["".join(rnd.choice(alphabet, 60)) for _ in range(3000)]
    texts += ["".join(rnd.choice(list("0123456789 -.+("), 40)) for _ in range(3000)]
    for t in texts:
        got = [(personal_data.KINDS[k], a, b) for k, a, b, _ in personal_data.base_spans(t)]
        assert got == naive_spans(t), t


def brute_sanitised(docs):
    """All counts by plain loops; rows of (doc_id, base, all spans)."""
    parsed = []
    for i, text in docs:
        base = naive_spans(text or "")
        blank = list(text or "")
        for _, a, b in base:
            blank[a:b] = "\x00" * (b - a)
        terms = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"\w\w+", "".join(blank))]
        mentions = []
        for kind, a, b in base:
            v = text[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[a:b])
            before = [t for t in terms if t[0] < a][-8:]
            mentions.append(((kind, v), {t[2] for t in before} | {t[2] for t in [t for t in terms if t[0] >= b][:8]}))
        parsed.append((i, text, base, terms, mentions))
    n = len(parsed)

    def general(t):
        return t[:4] + "*" if len(t) > 4 else None
    df_t, df_c, joint, texts = (collections.Counter() for _ in range(4))
    seen = set()
    for i, text, base, terms, mentions in parsed:
        words = {t for _, _, t in terms}
        df_t.update(words | {general(t) for t in words} - {None})
        df_c.update({c for c, _ in mentions})
        pairs = {(c, t) for c, near in mentions for t in near}
        pairs |= {(c, general(t)) for c, t in pairs if general(t)}
        joint.update(pairs)
        texts.update(p for p in pairs if (p, text) not in seen)
        seen |= {(p, text) for p in pairs}

    def strong(c, t):
        ic = math.log2(n / df_c[c])
        return texts[c, t] >= 3 and ic > 0 and math.log2(n * joint[c, t] / (df_c[c] * df_t[t])) >= ic / 1.5 - 1e-9
    out = []
    for i, text, base, terms, mentions in parsed:
        kinds = {}
        for c, near in mentions:
            for t in near:
                if strong(c, t):
                    kind = "generalised" if general(t) and not strong(c, general(t)) else "removed"
                    kinds[t] = "removed" if kind == "removed" else kinds.get(t, kind)
        extra = sorted(((kinds[t], a, b) for a, b, t in terms if t in kinds), key=lambda s: (personal_data.KINDS.index(s[0]), s[1]))
        out.append((i, base, base + extra))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def planted_documents():
    """One value whose neighbourhood gives it away, one that stands anywhere, copies that are no evidence."""
    rnd = np.random.default_rng(7)
    common = [f"word{k}" for k in range(60)]

    def noise(k):
        return " ".join(rnd.choice(common, k))
    docs = [(i, f"{noise(12)} {noise(12)}.") for i in range(200)]
    docs += [(300 + i, f"{noise(9)} surgeon Zyxwell wordsmith of ward0{i} ann@clinic.example.org {noise(9)} Zyxwell {noise(20)} ZYXWELL") for i in range(6)]
    docs += [(400 + i, f"{noise(9)} kirchberg{i} {noise(9)} 10.1.2.{i} {noise(9)}") for i in range(30)]
    docs += [(500 + i, "quiet qwertz uiop +1 (988) 555-2485 asdfg hjkl") for i in range(5)]
    docs += [(600 + i, f"{noise(5)} zyxtra{i} {noise(5)}") for i in range(40)]
    return docs


def test_sanitisation_against_brute_force(spark):
    docs = planted_documents()
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, spans int")
    got = {r.doc_id: r for r in personal_data.personal_data(df).select(
        "*", personal_data.written(F.col("base")).alias("b"), personal_data.written(F.col("spans")).alias("s")).collect()}
    for i, base, spans in brute_sanitised(docs):
        assert (got[i].b, got[i].s) == (joined(base), joined(spans)), i
    assert "Zyxwell" not in got[300].clean and "ZYXWELL" not in got[300].clean and "ann@" not in got[300].clean
    assert got[500].clean == "quiet qwertz uiop [PHONE] asdfg hjkl"  # five copies of one text are no evidence
    assert got[0].clean is None and all(got[400 + k].s.count(":") == 2 for k in range(30))
    kinds = {s.split(":")[0] for r in got.values() for s in r.s.split(",") if s}
    assert "generalised" in kinds and "word* " in got[300].clean  # a rare term of a common class
    back = {r.doc_id: r for r in personal_data.sanitise(df).collect()}
    assert len(back) == len(docs) and back[0].text == docs[0][1] and back[300].text == got[300].clean and back[300].spans == 1


def test_personal_data_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op12_personal_data"](spark, MEDIUM).collect()}
    assert len(got) == len(docs)
    for i, base, spans in brute_sanitised(docs):
        r = got[i]
        assert r.base_sha256 == sha(joined(base)) and r.spans == joined(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in NAIVE]


def test_personal_data_edges(spark):
    long = "a" * 200_000
    rows = [(1, None), (None, None), (2, ""), (3, long), (4, long + "@b.cd"), (5, "7" * 100_000), (6, "mail bob@x.org"), (6, "mail bob@x.org"),
            (None, "mail bob@x.org"), (7, "İstanbul bob@x.org İ"), (8, "+1 (555) 010-0200@x.org")]
    df = spark.createDataFrame([(i, t, "k", 2) for i, t in rows], "doc_id bigint, text string, kind string, _th int")
    got = personal_data.personal_data(df).collect()
    assert len(got) == 11
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [len(by[6]), by[6][0].clean, by[6][1].clean] == [2, "mail [EMAIL]", "mail [EMAIL]"]
    assert sorted(str(r.clean) for r in by[None]) == ["None", "mail [EMAIL]"]
    assert by[4][0].base[0].start == 0 and by[4][0].base[0].end == 200_005 and by[3][0].base == [] and by[5][0].base == []
    assert by[7][0].clean == "İstanbul [EMAIL] İ"
    assert [(s.kind, s.start, s.end) for s in by[8][0].spans] == [(0, 9, 23), (3, 0, 17)] and by[8][0].clean == "[EMAIL]"
    assert personal_data.personal_data(df.filter("false")).count() == 0 and personal_data.sanitise(df.filter("false")).count() == 0
    assert sorted(personal_data.sanitise(df).columns) == sorted(df.columns) and personal_data.sanitise(df).count() == 11
