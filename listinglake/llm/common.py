"""Helpers shared by the training-data operators.

A document row is identified by its *row key*: ``doc_id`` and ``_th``, the XXH64 of the text (both
null-safe). Decisions are made on narrow row-key tables and joined back once, so the texts are
shuffled at most once, and extra columns travel inside one struct (``_doc``), where their names
cannot clash with an operator's own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglake.session import scratch_path

#: rows and bytes of text handed to one call of a batch function (a longer text goes alone)
BATCH_ROWS, BATCH_BYTES = 256, 1 << 24


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors,
    and gives later joins a known size and an exchange of their own on both sides."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def text_hash(text: Column | str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def packed(docs: DataFrame) -> DataFrame:
    """``_doc`` (the whole row) with ``doc_id`` and ``_th`` beside it."""
    return docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("doc_id"), text_hash().alias("_th"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("_doc.*")


def one_row_per_key(docs: DataFrame) -> DataFrame:
    """Packed documents, repeated rows (equal row key) reduced map-side to the one whose other
    columns hash smallest."""
    order = [c for c, f in zip(docs.columns, docs.schema.fields)
             if not isinstance(f.dataType, (T.MapType, T.VariantType)) and c not in ("doc_id", "text")]
    rank = F.xxhash64(*[F.col(f"_doc.`{c}`") for c in order]) if order else F.lit(0)
    return packed(docs).groupBy("doc_id", "_th").agg(F.min_by("_doc", rank).alias("_doc"))


def keyed_join(rows: DataFrame, keys: DataFrame, how: str, small: bool = False) -> DataFrame:
    """Join on the row key, null ids equal; ``keys`` has doc_id and _th. ``small``: the keys are usually few
    and are broadcast if their count allows it, so that the texts need no shuffle."""
    k = (counted_broadcast(keys) if small else keys).select(F.col("doc_id").alias("_k_id"), F.col("_th").alias("_k_th"))
    return rows.join(k, F.col("doc_id").eqNullSafe(F.col("_k_id")) & (F.col("_th") == F.col("_k_th")), how)


#: values up to which a stored table is broadcast (16 to 32 bytes each, some 30 MB in a hash table)
BROADCAST_ROWS = 500_000


def counted_broadcast(df: DataFrame, most: int = BROADCAST_ROWS, size: Column | None = None) -> DataFrame:
    """A stored table with the broadcast hint if its counted values allow it; beyond, Spark shuffles it.
    ``size``: how many values a row holds (one if not given); no other column may be an array."""
    total = df.agg(F.sum(size) if size is not None else F.count("*")).first()[0]
    return F.broadcast(df) if (total or 0) <= most else df


def crc_mod(column: str, n: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def cut_batches(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most so many rows and bytes of strings. What a plan's batches hold is set
    by the session when the plan runs, so no operator relies on it."""
    for b in batches:
        total = np.zeros(b.num_rows, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type):
                total += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(total), 0
        while start < b.num_rows:
            before = total[start - 1] if start else 0
            end = min(start + rows, max(start + 1, int(np.searchsorted(total, before + size, "right"))))
            yield b.slice(start, end - start)
            start = end


def mapped(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` with one dict of columns out per part of a batch in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cut_batches(batches, rows):
            yield pa.RecordBatch.from_pydict(fn(b))

    return df.mapInArrow(run, schema)


class WordTable(dict):
    """Word → row of a growing float matrix. Rows are computed once per distinct word by
    ``compute(words) -> matrix``, for words of about ``PART`` characters at a time; the table is emptied
    when it holds ``most`` words or ``CHARS`` characters, so a task's memory is bounded by these and the
    words of one call, whatever the vocabulary and however long the words."""

    PART, CHARS = 1 << 18, 1 << 24

    def __init__(self, compute: Callable[[list], np.ndarray], width: int, most: int = 150_000):
        super().__init__()
        self.compute, self.most, self.width = compute, most, width
        self.rows = np.zeros((1024, width), np.float32)
        self.fresh: list = []
        self.chars = 0

    def __missing__(self, word):
        i = self[word] = len(self)
        self.fresh.append(word)
        return i

    def ids(self, words: list) -> np.ndarray:
        """Row numbers of the words, valid until the next call."""
        if len(self) > self.most or self.chars > self.CHARS:
            self.clear()
            self.chars = 0
        out = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.fresh:
            n = len(self)
            if n > len(self.rows):
                grown = np.zeros((max(n, 2 * len(self.rows)), self.width), np.float32)
                grown[:len(self.rows)] = self.rows
                self.rows = grown
            at = n - len(self.fresh)
            for a, b in chunks(self.fresh, self.PART):
                self.rows[at + a:at + b] = self.compute(self.fresh[a:b])
            self.chars += sum(map(len, self.fresh))
            self.fresh = []
        return out


def chunks(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of at most about ``most`` characters (one text at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


class Grams:
    """Hashed character n-grams of words set in ``<`` and ``>``, computed for all words at once.
    ``ids`` are the buckets in word order, ``sizes`` how many each word has (at least one, as 2 is
    among the lengths), ``words`` a bucket for each whole word."""
    _mix = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)

    def __init__(self, words: list[str], lengths: tuple[int, ...], bits: int, word_bits: int):
        codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 2
        start = np.cumsum(size) - size
        place = np.arange(len(codes)) - np.repeat(start, size)
        left = np.repeat(size, size) - place
        ids = np.empty((len(codes), len(lengths)), np.int64)
        valid = np.empty((len(codes), len(lengths)), bool)
        padded = np.concatenate([codes, np.zeros(max(lengths), np.uint64)])
        for c, k in enumerate(lengths):
            h = np.full(len(codes), k, np.uint64)
            for j in range(k):
                h = (h ^ padded[j:j + len(codes)]) * self._mix[j]
                h ^= h >> np.uint64(31)
            ids[:, c] = (h * self._mix[0]) >> np.uint64(64 - bits)
            valid[:, c] = left >= k
        self.ids = ids[valid]
        self.sizes = np.add.reduceat(valid.sum(axis=1), start)
        spread = (codes + np.uint64(7)) * (place.astype(np.uint64) * self._mix[1] + self._mix[2] | np.uint64(1))
        self.words = ((np.add.reduceat(spread, start) * self._mix[0]) >> np.uint64(64 - word_bits)).astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' rows of a table, for each word."""
        return np.add.reduceat(table[self.ids], self.first, axis=0)
