"""Token counts (operator 7) of a byte-level BPE vocabulary by whole-token shortcuts.

A text is cut into pre-tokens by the tokenizer's own pattern. Offline, once per process, the merge
rules are applied to every string of the vocabulary that is a pre-token of its own: those that end as
one token are proven to count 1 and go into the shortcut table. Pre-tokens of a text that are in the
table are counted by a look-up; only the others are merged, and their counts are kept in a table of
bounded size.

Special strings of the vocabulary inside a text are one token each, as the library does by default.

Defined results: null text is empty and has no tokens; an empty table returns no rows; repeated rows
and null doc_ids are counted like any other; other columns are never read.
"""

from __future__ import annotations

import json
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_type, mapped

#: merged pre-tokens kept by a process
KEPT = 400_000


def byte_letters() -> dict[int, str]:
    """The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the others
    for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TokenCounter:
    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(pairs)}
        self.letters = byte_letters()
        added = [t["content"] for t in spec.get("added_tokens", []) if t["content"]]
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])):
            raise ValueError(f"{path}: added tokens that take their surroundings are not supported")
        self.special = regex.compile("|".join(regex.escape(a) for a in sorted(added, key=len, reverse=True))) if added else None
        self.words = regex.compile(pattern)
        self.counts: dict[str, int] = {}
        self.whole = self.prove(model["vocab"])

    def merged(self, word: str) -> int:
        """Tokens of one pre-token: merge the best-ranked neighbours until none is left."""
        parts = [self.letters[b] for b in word.encode()]
        ranks = self.ranks
        while len(parts) > 1:
            best, rank = None, len(ranks)
            for pair in zip(parts, parts[1:]):
                r = ranks.get(pair, rank)
                if r < rank:
                    best, rank = pair, r
            if best is None:
                break
            a, b = best
            out, i, n = [], 0, len(parts)
            while i < n:
                if i + 1 < n and parts[i] == a and parts[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return len(parts)

    def prove(self, vocab: dict[str, int]) -> dict[str, int]:
        """Vocabulary strings that are one pre-token and merge to one token."""
        back = {c: b for b, c in self.letters.items()}
        out = {}
        for token in vocab:
            try:
                word = bytes(back[c] for c in token).decode()
            except (KeyError, UnicodeDecodeError):
                continue  # a special string, or part of a character: never a pre-token
            m = self.words.match(word)
            if m and m.end() == len(word) and self.merged(word) == 1:
                out[word] = 1
        return out

    def _piece(self, text: str) -> int:
        whole, counts, total = self.whole, self.counts, 0
        found = self.words.findall(text) if len(text) < 1 << 20 else (m[0] for m in self.words.finditer(text))
        found = iter(found)
        while block := list(islice(found, 65_536)):
            for w in block:
                if w in whole:
                    total += 1
                    continue
                n = counts.get(w)
                if n is None:
                    if len(counts) >= KEPT:
                        counts.clear()
                    n = self.merged(w) if len(w) < 64 else long_merged(self, w)
                    if len(w) < 64:
                        counts[w] = n
                total += n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None:
            return self._piece(text)
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += self._piece(text[at:m.start()]) + 1
            at = m.end()
        return total + self._piece(text[at:] if at else text)


def long_merged(c: TokenCounter, word: str) -> int:
    """As ``merged`` for long pre-tokens, with a heap over linked parts: n log n instead of n squared."""
    import heapq
    parts = [c.letters[b] for b in word.encode()]
    n = len(parts)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := c.ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    alive = n
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i] if parts[i] is not None else -1
        if j < 0 or parts[i] != a or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        alive -= 1
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        for x in (left[i], i):
            y = right[x] if x >= 0 else -1
            if y >= 0 and (r := c.ranks.get((parts[x], parts[y]))) is not None:
                heapq.heappush(heap, (r, x, parts[x], parts[y]))
    return alive


_COUNTERS: dict[tuple[str, str], TokenCounter] = {}


def counter(path: str, pattern: str) -> TokenCounter:
    """One per process: the proof takes about a second."""
    if (path, pattern) not in _COUNTERS:
        _COUNTERS[path, pattern] = TokenCounter(path, pattern)
    return _COUNTERS[path, pattern]


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. ``path`` is read on the executors, where the tokenizer's
    files are installed as the libraries are."""
    def batch(b: pa.RecordBatch) -> dict:
        c = counter(path, pattern)
        return {"doc_id": b.column("doc_id"), "n_bytes": b.column("n_bytes"),
                "n_tokens": pa.array([c.count(t.as_py()) for t in b.column("text")], pa.int64())}

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    out = mapped(rows, batch, f"doc_id {id_type(docs)}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
