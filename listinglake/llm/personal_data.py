"""Personal data (operator 12): patterns, then information-theoretic sanitisation of what is left.

Base: e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers are found by pattern,
leftmost and non-overlapping for each kind. Each distinct value is a protected entity c.

A term that stands next to a protected value may give it away after the value is gone. How strongly a
term t reveals c is estimated from the corpus: PMI(c; t) = log2(N * joint / (df_c * df_t)) with the
numbers of documents, joint those with t among the ``WINDOW`` terms before or after a mention of c. The
value's own information is IC(c) = log2(N / df_c), and PMI never exceeds it. A term discloses c when
PMI >= IC / ``ALPHA``, seen in at least ``SUPPORT`` different texts (copies are no evidence). A disclosing
term is generalised to its first ``STEM`` letters if those, counted in the same way, do not disclose c,
and removed if they do or if it is no longer than that - everywhere in the documents where it stands
near c. Documents without a base match are never changed.

Counting is linear: at most 2 * ``WINDOW`` terms for a mention, and one count for each distinct term of
a task, reduced to the terms in question before it is shuffled where these are few.

Defined results: null text counts as empty and has no spans; a null doc_id is like any other; of
repeated rows each gets the same result; an empty table returns no rows; extra columns are never read
and ``sanitise`` returns them as they were; spans of different kinds may overlap, the text is replaced
once, with the mark of the kind listed first.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import counted_broadcast, cut_batches, id_type, mapped, packed, stored, text_hash, unpacked

WINDOW, SUPPORT, ALPHA, STEM = 8, 3, 1.5, 4
#: distinct terms, and their characters, counted by a task before it hands them on
COUNTED, COUNTED_CHARS = 300_000, 8_000_000
KINDS = ("email", "ip", "card", "phone", "generalised", "removed")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")
TERM = re.compile(r"\w\w+")


def emails(text: str):
    """One pass from ``@`` to ``@``: the local part is the run before it that no earlier match has taken."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", end if m else at + 1)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) by kind, then start."""
    out = [(0, a, b, text[a:b].lower()) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) < 4 and int(p or "0") < 256 for p in parts):
                out.append((1, m.start(), m.end(), m[0]))
        for m in CARD.finditer(text):
            if 13 <= m.end() - m.start() <= 37:
                digits = NO_DIGIT.sub("", m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end(), digits))
        if "+" in text:
            for m in PHONE.finditer(text):
                digits = NO_DIGIT.sub("", m[0])
                if 9 <= len(digits) <= 15:
                    out.append((3, m.start(), m.end(), digits))
    return out


def covered(spans: list) -> list[tuple[int, int]]:
    """Union of the spans, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s[1], s[2]) for s in spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def open_terms(text: str, spans: list) -> list[tuple[int, int, str]]:
    """(start, end, term) of the words of two characters or more outside the spans."""
    out, at = [], 0
    for a, b in [*covered(spans), (len(text), len(text))]:
        out += [(m.start(), m.end(), m[0].lower()) for m in TERM.finditer(text, at, a)]
        at = b
    return out


def general(term: str) -> str | None:
    """The class a term may be generalised to."""
    return f"{term[:STEM]}*" if len(term) > STEM else None


def neighbours(spans: list, terms: list, window: int) -> list[tuple[int, str]]:
    """(span number, term) for the terms before and after each span."""
    from bisect import bisect_left
    starts = [t[0] for t in terms]
    out = []
    for k, (_, a, b, _) in enumerate(spans):
        before, after = bisect_left(starts, a), bisect_left(starts, b)
        out += [(k, t[2]) for t in terms[max(0, before - window):before] + terms[after:after + window]]
    return out


def _hash(value: str) -> int:
    """Spark's xxhash64 of a string."""
    h = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), 42)
    return h - (1 << 64) if h >> 63 else h


def found(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, _th, n_email, n_ip, n_card, n_phone, base (kind, start, end), near (entity, term; distinct),
    entities (distinct), text (null where there is no match) for every document row."""
    def batch(b: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base", "near", "entities", "text")}
        for t in b.column("text"):
            text = t.as_py()
            spans = base_spans(text)
            numbers = Counter(s[0] for s in spans)
            for k, c in enumerate(("n_email", "n_ip", "n_card", "n_phone")):
                out[c].append(numbers[k])
            out["base"].append([{"kind": k, "start": a, "end": e} for k, a, e, _ in spans])
            own = [_hash(f"{KINDS[k]}:{v}") for k, _, _, v in spans]
            near = {(own[k], term) for k, term in neighbours(spans, open_terms(text, spans), window)} if spans else ()
            out["near"].append([{"entity": e, "term": term} for e, term in sorted(near)])
            out["entities"].append(sorted(set(own)))
            out["text"].append(text if spans else None)
        spot = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
        pair = pa.struct([("entity", pa.int64()), ("term", pa.string())])
        return {"doc_id": b.column("doc_id"), "_th": b.column("_th"),
                **{c: pa.array(out[c], pa.int64()) for c in ("n_email", "n_ip", "n_card", "n_phone")},
                "base": pa.array(out["base"], pa.list_(spot)), "near": pa.array(out["near"], pa.list_(pair)),
                "entities": pa.array(out["entities"], pa.list_(pa.int64())), "text": pa.array(out["text"], pa.string())}

    rows = docs.select("doc_id", text_hash().alias("_th"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return mapped(rows, batch, f"doc_id {id_type(docs)}, _th bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                  "base array<struct<kind:int,start:bigint,end:bigint>>, near array<struct<entity:bigint,term:string>>, "
                  "entities array<bigint>, text string")


def term_counts(docs: DataFrame) -> DataFrame:
    """h, n: hash of a term or of a general term, and in how many documents of a part of a task it stands."""
    def run(batches):
        counts: Counter = Counter()
        chars = 0

        def ready():
            return pa.RecordBatch.from_pydict({"h": pa.array(map(_hash, counts), pa.int64()), "n": pa.array(counts.values(), pa.int64())})

        for b in cut_batches(batches):
            for t in b.column("text"):
                text = t.as_py()
                spans = base_spans(text)
                if spans:
                    terms = {t for _, _, t in open_terms(text, spans)}
                else:
                    terms = {w.lower() for w in set(TERM.findall(text))}
                terms |= {f"{t[:STEM]}*" for t in terms if len(t) > STEM}
                before = len(counts)
                counts.update(terms)
                if len(counts) > before:
                    chars += sum(map(len, terms))
                if len(counts) > COUNTED or chars > COUNTED_CHARS:
                    yield ready()
                    counts, chars = Counter(), 0
        if counts:
            yield ready()

    return docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, "h bigint, n bigint")


def disclosing(docs: DataFrame, rows: DataFrame, n: int, support: int = SUPPORT, alpha: float = ALPHA) -> DataFrame:
    """entity, term, kind: the terms that reveal an entity, and whether they are generalised or removed.
    ``rows`` is the stored result of ``found``, ``n`` the number of documents."""
    pairs = rows.select("_th", F.explode("near").alias("p")).select("_th", "p.entity", "p.term")
    stem = F.when(F.length("term") > STEM, F.concat(F.substring("term", 1, STEM), F.lit("*")))
    # a document has many terms of one class near an entity and counts once for it
    classes = rows.select("doc_id", "_th", F.explode(F.array_distinct(F.filter(F.transform("near", lambda p: F.struct(
        p["entity"].alias("entity"), F.when(F.length(p["term"]) > STEM, F.concat(F.substring(p["term"], 1, STEM), F.lit("*"))).alias("term"))),
        lambda p: p["term"].isNotNull()))).alias("p")).select("_th", "p.entity", "p.term")
    by_text = pairs.union(classes).groupBy("entity", "term", "_th").agg(F.count("*").alias("docs"))
    joint = by_text.groupBy("entity", "term").agg(F.sum("docs").alias("joint"), F.count("*").alias("texts"))
    joint = stored(joint.filter(F.col("texts") >= support).withColumn("h", F.xxhash64("term")), "pii-joint")
    asked = stored(joint.select("h").distinct(), "pii-terms")
    counts = term_counts(docs).join(counted_broadcast(asked), "h", "left_semi").groupBy("h").agg(F.sum("n").alias("df_t"))
    owners = rows.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("df_c"))
    known = joint.join(stored(counts, "pii-term-counts"), "h").join(stored(owners, "pii-entities"), "entity")
    own = F.log2(F.lit(float(n)) / F.col("df_c"))
    pmi = F.log2(F.lit(float(n)) * F.col("joint") / (F.col("df_c") * F.col("df_t")))
    # sums of logarithms: a term that stands with one entity only has all of its information, to the last bits
    strong = stored(known.filter((own > 0) & (pmi >= own / alpha - 1e-9)).select("entity", "term"), "pii-strong")
    strong_classes = strong.filter(F.col("term").endswith("*")).select("entity", F.col("term").alias("stem"), F.lit(True).alias("too"))
    terms = strong.filter(~F.col("term").endswith("*")).withColumn("stem", stem)
    kind = F.when(F.col("stem").isNotNull() & F.col("too").isNull(), KINDS.index("generalised")).otherwise(KINDS.index("removed"))
    return terms.join(strong_classes, ["entity", "stem"], "left").select("entity", "term", kind.alias("kind"))


MARKS = {0: "[EMAIL]", 1: "[IP]", 2: "[CARD]", 3: "[PHONE]", 5: "[REMOVED]"}


def replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every covered stretch replaced by the mark of its kind listed first."""
    out, at = [], 0
    first = sorted(spans, key=lambda s: s[1])
    k = 0
    for a, b in covered(spans):
        kinds = []
        while k < len(first) and first[k][1] < b:
            kinds.append(first[k][0])
            k += 1
        kind = min(kinds)
        out += [text[at:a], MARKS[kind] if kind in MARKS else f"{text[a:a + STEM]}*"]
        at = b
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, window: int = WINDOW, support: int = SUPPORT, alpha: float = ALPHA) -> DataFrame:
    """For every document row: doc_id, _th, n_email, n_ip, n_card, n_phone, base and spans (kind, start, end;
    kind is the place in ``KINDS``; by kind, then start), clean (the text without them, null where nothing
    was found)."""
    rows = stored(found(docs, window), "pii-found")
    marked = disclosing(docs, rows, docs.count(), support, alpha)
    own = rows.filter(F.size("near") > 0).select("doc_id", "_th", F.explode("near").alias("p")).select("doc_id", "_th", "p.entity", "p.term")
    terms = own.join(stored(marked, "pii-disclosing"), ["entity", "term"])
    actions = terms.groupBy("doc_id", "_th").agg(F.collect_set(F.struct("term", "kind")).alias("terms"))
    actions = stored(actions, "pii-actions").select(F.col("doc_id").alias("a_id"), F.col("_th").alias("a_th"), "terms")
    hit = rows.filter(F.col("text").isNotNull()).join(
        actions, F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("_th") == F.col("a_th")), "left")
    spot = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])

    def batch(b: pa.RecordBatch) -> dict:
        spans_out, clean = [], []
        for text, base, terms in zip(b.column("text").to_pylist(), b.column("base").to_pylist(), b.column("terms").to_pylist()):
            spans = [(s["kind"], s["start"], s["end"]) for s in base]
            if terms:
                # a term marked for two entities is removed if either asks for it
                kinds: dict[str, int] = {}
                for t in terms:
                    kinds[t["term"]] = max(t["kind"], kinds.get(t["term"], 0))
                spans += [(kinds[t], a, e) for a, e, t in open_terms(text, spans) if t in kinds]
                spans.sort()
            spans_out.append([{"kind": k, "start": a, "end": e} for k, a, e in spans])
            clean.append(replaced(text, spans))
        return {**{c: b.column(c) for c in keep}, "spans": pa.array(spans_out, pa.list_(spot)), "clean": pa.array(clean, pa.string())}

    keep = ["doc_id", "_th", "n_email", "n_ip", "n_card", "n_phone", "base"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    done = mapped(hit.select(*keep, "text", "terms"), batch, f"{schema}, spans array<struct<kind:int,start:bigint,end:bigint>>, clean string")
    rest = rows.filter(F.col("text").isNull()).select(*keep, F.col("base").alias("spans"), F.lit(None).cast("string").alias("clean"))
    return done.unionByName(rest)


def sanitise(docs: DataFrame, window: int = WINDOW, support: int = SUPPORT, alpha: float = ALPHA) -> DataFrame:
    """The documents with their texts cleaned, all other columns as they were."""
    clean = personal_data(docs, window, support, alpha).filter(F.col("clean").isNotNull())
    clean = stored(clean.groupBy("doc_id", "_th").agg(F.min("clean").alias("clean")), "pii-clean")
    k = clean.select(F.col("doc_id").alias("k_id"), F.col("_th").alias("k_th"), "clean")
    rows = packed(docs).join(k, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("_th") == F.col("k_th")), "left")
    return unpacked(rows.withColumn("_doc", F.col("_doc").withField("text", F.coalesce("clean", "_doc.text")))).select(*docs.columns)


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
