"""Exact dedup (operator 2): a persistent digest index, bucketed and sorted by hash.

A text's digest is the SHA-256 of the text without the characters ``[\\x20\\x09-\\x0D]``. Each batch
is reduced to one entry per digest before it leaves the map side, anti-joined (sort-merge, the index
side is read bucketed and does not shuffle) with the index, and the new entries are appended. The
batch's digests, one row each, then take their entries from the index in the same way; only this
result meets the documents, both sides shuffled, so that adaptive execution splits a digest that holds
a third of all rows. Every append adds a file to the buckets it touches; ``compact`` makes them one
sorted file each again.

Defined results: null text counts as empty; a null doc_id loses against any other; of rows that tie
in length and doc_id the smaller text hash stays; of fully equal repeated rows one stays; an empty
table appends nothing and returns no rows; other columns are never read. As the index outlives the
batch, ids are stored as bigint: doc_id must be of a type that casts to it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.session import scratch_path

from .common import keyed_join, one_row_per_key, stored, text_hash, unpacked

BLANKS = " \t\n\x0b\x0c\r"
ENTRY = "digest binary, keep_len int, keep_id bigint, keep_th bigint, batch string"
SPEC = "buckets int, version int, folder string"


def digests(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("_th"),
                       F.unhex(F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256)).alias("digest"),
                       F.length(text).alias("n"))


class DigestIndex:
    """Index in ``path`` (a new one in the shared folder if not given). ``path`` may be opened again
    by a later session; the bucket count is fixed when the index is made and kept beside it."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "llm-digest-index")
        spec = f"{self.path}/_spec"
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(spec)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            last = spark.read.schema(SPEC).parquet(spec).orderBy(F.desc("version")).first()
            self.buckets, self.version, folder = last["buckets"], last["version"] or 0, last["folder"] or "entries"
        else:
            self.buckets, self.version, folder = buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), 0, "entries"
            self._note(folder)
        self._open(folder)

    def _note(self, folder: str) -> None:
        """Make a folder of entries the current one."""
        (self.spark.createDataFrame([(self.buckets, self.version, folder)], SPEC).coalesce(1)
         .write.mode("append").parquet(f"{self.path}/_spec"))

    def _open(self, folder: str) -> None:
        self.entries_path = f"{self.path}/{folder}"
        self.table = f"llm_digest_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"CREATE TABLE {self.table} ({ENTRY}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.entries_path}'")

    def _append(self, entries: DataFrame, table: str) -> None:
        """One file per bucket."""
        (entries.repartition(self.buckets, "digest").write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.entries_path).mode("append").saveAsTable(table))

    def meeting(self, groups: DataFrame, how: str, *columns: str) -> DataFrame:
        """One row per digest joined with the index: only the batch's side is shuffled."""
        known = self.spark.table(self.table).select("digest", *columns)
        return groups.hint("merge").join(known.hint("merge"), "digest", how)

    def compact(self) -> None:
        """The entries in a new folder with one sorted file per bucket; a reader of the old one is not disturbed."""
        rest = [f"{f.split()[0]}" for f in ENTRY.split(", ") if not f.startswith("digest")]
        one = self.spark.table(self.table).groupBy("digest").agg(F.min(F.struct("batch", *[c for c in rest if c != "batch"])).alias("e"))
        one = one.select("digest", *[F.col(f"e.{c}").alias(c) for c in rest])
        self.version += 1
        folder = f"entries-{self.version}-{uuid.uuid4().hex[:12]}"
        self._open(folder)
        self._append(one, self.table)
        self._note(folder)

    def ingest(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Append the batch's new digests; returns a row for each document of the batch: doc_id, _th,
        digest, keep_id, group_size (within the batch), kept. Ingesting the same batch name again
        appends nothing and returns the same rows."""
        batch = batch or uuid.uuid4().hex
        rows = stored(digests(docs).groupBy("doc_id", "_th", "digest", "n").agg(F.count("*").alias("copies")), "digests")
        order = F.struct((-F.col("n")).alias("len"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("_th"))
        best = rows.groupBy("digest").agg(F.min(order).alias("b"), F.sum("copies").alias("group_size"))
        groups = stored(best.select("digest", "group_size", (-F.col("b.len")).alias("keep_len"),
                                    F.col("b.doc_id").alias("keep_id"), F.col("b._th").alias("keep_th")), "digest-groups")
        new = self.meeting(groups.select("digest", "keep_len", "keep_id", "keep_th", F.lit(batch).alias("batch")), "left_anti")
        # stored first, so that a retried append sees the same rows
        self._append(stored(new, "digest-new"), self.table)
        kept = self.meeting(groups.select("digest", "group_size"), "inner", "keep_len", "keep_id", "keep_th", "batch")
        out = rows.join(stored(kept, "digest-kept"), "digest")
        is_kept = ((F.col("batch") == batch) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
                   & (F.col("_th") == F.col("keep_th")) & (F.col("n") == F.col("keep_len")))
        # repeated rows share a row key: they come back as many times, and one of them is kept
        return out.select("doc_id", "_th", "digest", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                          is_kept.alias("_best"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
                          ).select("doc_id", "_th", "digest", "keep_id", "group_size",
                                   (F.col("_best") & (F.col("_copy") == 1)).alias("kept"))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents whose row stays, all columns as they were."""
    index = index or DigestIndex(docs.sparkSession)
    kept = index.ingest(docs).filter("kept").select("doc_id", "_th")
    return unpacked(keyed_join(one_row_per_key(docs), stored(kept, "digest-stays"), "left_semi")
                    ).select(*docs.columns)
