"""Substring dedup (operator 1): sliding sentence spans.

Sentences end at ``.``, ``!`` or ``?`` before white space, at the full stops, question and exclamation
marks of other scripts (with or without white space behind), or at a line break. A run is ``RUN``
consecutive sentences, or as many more as reach ``min_words`` words together: the shortest such run
from every sentence on and the shortest up to every sentence, so that a repeated passage of
``min_words`` words or more is covered whole, however short its sentences. A text of one
sentence, or of fewer words, is one run. Characters of scripts without spaces count as words. Runs are
hashed to 128 bits (so that 10^13 runs stay free of collisions), counted globally with map-side
combination, and the repeated ones are joined back. The first occurrence of a run, by
(doc_id, text hash, position), stays; sentences covered by any other occurrence are removed, and the
rest of the text is put together again with its original white space.

Texts are cut and hashed in Arrow batches: every sentence once, all sentences of a batch in one array.
Running totals of words give the ends of all runs by binary search, and running totals of sentence
hashes times powers of an odd number give the hash of any run by one difference.

With ``run`` given, only runs of exactly so many sentences are looked at, and shorter ones than
``min_words`` are left out; the registered query does not use this.

Defined results: null text counts as empty and comes back empty; a null doc_id sorts last; a text
of one sentence is compared with other whole texts only; texts of white space are unchanged; repeated rows of one (doc_id, text) are one document
in the count and get the same result; a run that repeats inside a document is removed there too; an
empty table returns no rows; other columns are never read.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type, mapped, packed, stored, text_hash

RUN, MIN_WORDS = 2, 10
#: Thai, Lao, Tibetan, Burmese, Khmer, kana and Han characters
UNSPACED = ("\u0E01-\u0E3A\u0E40-\u0E4E\u0E81-\u0ECE\u0F40-\u0FBC\u1000-\u1049\u1780-\u17D3\u3005-\u3007\u3041-\u30FF"
            "\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\U00020000-\U0003FFFF")
#: CJK, Devanagari, Arabic, Urdu, Armenian, Ethiopic, Burmese, Khmer and Tibetan ends of sentences, and what closes them
MARKS, CLOSING = "。！？｡．‼⁇⁈⁉।॥؟۔։።፧፨။។៕།༎", "」』）】〉》”’"
ENDS = rf"([.!?][\x20\x09\x0B-\x0D]+\n?[\x20\x09-\x0D]*|[{MARKS}][{MARKS}!?]*[{CLOSING}]*[\x20\x09-\x0D\u3000]*|[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*)"
#: the same ends, found by their first mark or line break; the white space before a line break is no matter for a cut
CUT = re.compile(rf"[.!?\n{MARKS}](?:(?<=[.!?])[\x20\x09\x0B-\x0D][\x20\x09-\x0D]*+|(?<=\n)[\x20\x09-\x0D]*+"
                 rf"|(?<=[{MARKS}])[{MARKS}!?]*+[{CLOSING}]*+[\x20\x09-\x0D　]*+)")
CUT_ASCII = re.compile(r"[.!?\n](?:(?<=[.!?])[\x20\x09\x0B-\x0D][\x20\x09-\x0D]*+|(?<=\n)[\x20\x09-\x0D]*+)")
WIDE = re.compile(f"[{UNSPACED}]")
BLANK = {c: " " for c in range(9, 14)}
# fixed values: an odd number and its inverse modulo 2^64
POWER = 0xD1342543DE82EF95
INVERSE = pow(POWER, -1, 1 << 64)


def cuts(text: str) -> list[int]:
    """Where the sentences of a text end; white space behind a sentence belongs to it."""
    ends = [m.end() for m in (CUT_ASCII if text.isascii() else CUT).finditer(text)]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


def pieces(text: str) -> list[str]:
    """The text cut behind every sentence; the pieces put together are the text again."""
    ends = cuts(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def normalised(text: str) -> list[str]:
    """The sentences in lower case, all white space as blanks, none around them."""
    flat = text.translate(BLANK)
    ends = cuts(text)
    if flat.isascii():
        flat = flat.lower()
        return [flat[a:b].strip(" ") for a, b in zip([0, *ends], ends)]
    return [flat[a:b].strip(" ").lower() for a, b in zip([0, *ends], ends)]


def words(sentence: str) -> int:
    return sentence.count(" ") + (1 if sentence.isascii() else max(1, len(WIDE.findall(sentence))))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def runs(texts: list[str], run: int | None, min_words: int) -> tuple[np.ndarray, ...]:
    """(text number, position, length, hash, hash) of the runs of some texts: with ``run``, of exactly so
    many sentences with ``min_words`` words; else the shortest of ``RUN`` sentences or more with as many
    words from and up to every sentence, or the whole of a text that has none."""
    cut = [normalised(t) for t in texts]
    size = np.fromiter(map(len, cut), np.int64, len(cut))
    flat = list(chain.from_iterable(cut))
    n = len(flat)
    start = np.cumsum(size) - size
    text = np.repeat(np.arange(len(cut)), size)
    total = np.concatenate([[0], np.cumsum(np.fromiter(map(words, flat), np.int64, n))])
    at = np.arange(n)
    if run is not None:
        a, e = at, at + run
        ok = e <= (start + size)[text]
        a, e = a[ok], e[ok]
        enough = total[e] - total[a] >= min_words
        a, e = a[enough], e[enough]
    else:
        e = np.maximum(at + RUN, np.searchsorted(total, total[:-1] + min_words, "left"))
        b = np.minimum(at + 1 - RUN, np.searchsorted(total, total[1:] - min_words, "right") - 1)
        ahead, behind = e <= (start + size)[text], b >= start[text]
        codes = np.unique(np.concatenate([at[ahead] * (n + 1) + e[ahead], b[behind] * (n + 1) + at[behind] + 1]))
        a, e = codes // (n + 1), codes % (n + 1)
        alone = np.ones(len(cut), bool)
        alone[text[a]] = False
        alone = np.flatnonzero(alone & np.array([any(c) for c in cut], bool))
        a, e = np.concatenate([a, start[alone]]), np.concatenate([e, (start + size)[alone]])
    h = np.frombuffer(b"".join([xxhash.xxh3_128_digest(s.encode()) for s in flat]), "<u8").reshape(n, 2)
    rise, fall = _powers(POWER, n), _powers(INVERSE, n)
    out = []
    for k in range(2):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h[:, k] * rise, dtype=np.uint64)])
        x = (sums[e] - sums[a]) * (fall[a] if n else np.zeros(0, np.uint64)) + (e - a).astype(np.uint64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(POWER)
        out.append((x ^ (x >> np.uint64(29))).view(np.int64))
    return text[a], a - start[text[a]], e - a, *out


def removed_sentences(docs: DataFrame, run: int | None = None, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, _th, spans: sorted positions and lengths of the non-first repeated runs of a document."""
    def batch(b: pa.RecordBatch) -> dict:
        who, pos, size, h1, h2 = runs(b.column("text").to_pylist(), run, min_words)
        who = pa.array(who)
        return {"doc_id": b.column("doc_id").take(who), "_th": b.column("_th").take(who),
                "pos": pa.array(pos, pa.int32()), "len": pa.array(size, pa.int32()), "h1": h1, "h2": h2}

    rows = docs.select("doc_id", text_hash().alias("_th"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = stored(mapped(rows, batch, f"doc_id {id_type(docs)}, _th bigint, pos int, len int, h1 bigint, h2 bigint"), "runs")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("_th"), F.col("pos"))
    first = rows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    # stored: both sides of the join get exchanges of their own, and a very common run is split
    later = rows.join(stored(first.select("h1", "h2", "first"), "repeated-runs"), ["h1", "h2"]).filter(place != F.col("first"))
    return later.groupBy("doc_id", "_th").agg(F.array_sort(F.collect_set(F.struct("pos", "len"))).alias("spans"))


def substring_dedup(docs: DataFrame, run: int | None = None, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text (what stays), n_sentences, n_removed, removed (positions) for every document row."""
    marks = stored(removed_sentences(docs, run, min_words), "removed")
    k = marks.select(F.col("doc_id").alias("m_id"), F.col("_th").alias("m_th"), "spans")
    rows = packed(docs.select("doc_id", "text")).join(
        k, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("_th") == F.col("m_th")), "left")
    rows = rows.select("doc_id", F.coalesce(F.col("_doc.text").cast("string"), F.lit("")).alias("text"), "spans")

    def batch(b: pa.RecordBatch) -> dict:
        out = {"text": [], "n_sentences": [], "n_removed": [], "removed": []}
        for i in range(b.num_rows):
            text, later = b.column("text")[i].as_py(), b.column("spans")[i].values
            ends = cuts(text)
            at = []
            if later is not None:
                gone = np.zeros(len(ends), bool)
                starts, sizes = (x.to_numpy() for x in later.flatten())
                for j in range(int(sizes.max())):
                    gone[starts[sizes > j] + j] = True
                at = np.flatnonzero(gone).tolist()
                text = "".join([text[a:e] for a, e, g in zip([0, *ends], ends, gone.tolist()) if not g])
            out["text"].append(text)
            out["n_sentences"].append(len(ends)), out["n_removed"].append(len(at)), out["removed"].append(at)
        return {"doc_id": b.column("doc_id"), "text": pa.array(out["text"], pa.string()), "n_sentences": pa.array(out["n_sentences"], pa.int32()),
                "n_removed": pa.array(out["n_removed"], pa.int32()), "removed": pa.array(out["removed"], pa.list_(pa.int32()))}

    return mapped(rows, batch, f"doc_id {id_type(docs)}, text string, n_sentences int, n_removed int, removed array<int>")
