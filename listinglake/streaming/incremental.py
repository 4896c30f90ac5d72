"""Incremental loads as Structured Streaming jobs (L1, L2).

* L1 — insert-ignore over a stream: ``withWatermark`` + ``dropDuplicatesWithinWatermark``.
  State is bounded by the watermark delay, so an id repeated later than the delay is emitted
  again (the batch form, with an unbounded unique index, would ignore it).
* L2 — each micro-batch of newly landed files is merged into a versioned warehouse table
  with ``foreachBatch``. Every merged batch leaves a (query, batch id) marker beside the versions
  (so removing old versions keeps it) and a batch whose marker exists is skipped, so a replayed
  batch (after a driver or executor loss) is idempotent; the merge keeps the row with the greatest ordinal per key, so the final
  state does not depend on how files were cut into batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import last_wins
from ..session import store
from ..sources.literals import empty_frame
from ..sources.sinks import commit_version, current_version, read_current


def stream_insert_ignore(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """L1: drop rows whose key was already seen within the watermark delay."""
    return (stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
                  .withWatermark(event_time, delay)
                  .dropDuplicatesWithinWatermark(keys))


def merge_batch(current: DataFrame | None, batch: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """State ∪ batch, greatest ordinal per key wins."""
    both = batch if current is None else current.unionByName(batch.select(*current.columns))
    return last_wins(both, key, [ordinal])


def upsert_writer(base: str, table: str, key: list[str], ordinal: str, query_name: str = "stream"):
    """``foreachBatch`` function committing ``merge(current, batch)`` as the next version of the
    table and then the marker ``_batches/<query>/<batch id>``: one look per batch, however many
    versions there are. A replayed batch whose marker already exists is skipped; a crash between the commit and the marker only re-applies the batch,
    which the greatest-ordinal merge absorbs (same state)."""
    from ..sources.sinks import _fs

    def _write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs, marker = _fs(spark, f"{base.rstrip('/')}/{table}/_batches/{query_name}/{batch_id}")
        if fs.exists(marker):
            return  # replay of a committed batch
        current = read_current(spark, base, table)
        commit_version(merge_batch(current, batch, key, ordinal), base, table)
        fs.create(marker, True).close()
    return _write


def run_available_now(writer, checkpoint: str) -> None:
    """Start a query with the ``availableNow`` trigger and wait for it to drain the input."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_upsert(spark: SparkSession, landing: str, glob: str, schema: T.StructType, base: str, table: str,
                  key: list[str], ordinal: str, checkpoint: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """L2: drain newly landed files into the versioned table; returns its current state."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.format(fmt).load(landing)
    run_available_now(stream.writeStream.foreachBatch(upsert_writer(base, table, key, ordinal)), checkpoint)
    return read_current(spark, base, table, schema)


# ------------------------------------------------------------------ upserts that rewrite only what they touch
class BucketedState:
    """A keyed table whose rows lie in hash buckets, with a manifest per version.

    ``<path>/data/<write>/bucket=<b>`` holds rows, ``<path>/manifests/v=<n>`` one row per bucket: the write that has its
    current rows. A batch reads and writes only the buckets its keys fall into; the next manifest refers to the old files
    for all others, so they are neither read nor copied. A version counts once its manifest is complete (``_SUCCESS``), and the
    manifest also names the last batch of every query, so commit and marker are one step and a replayed batch is skipped."""

    MANIFEST = "bucket int, folder string, query string, batch long"

    def __init__(self, spark: SparkSession, base: str, table: str, schema: T.StructType, key: list[str], ordinal: str, buckets: int):
        self.spark, self.path, self.schema, self.key, self.ordinal, self.buckets = (
            spark, f"{base.rstrip('/')}/{table}", schema, key, ordinal, buckets)

    def _manifest(self) -> list:
        """Rows of the current manifest: one per bucket with rows, one per query (bucket NULL)."""
        v = current_version(self.spark, self.path, "manifests")
        if v is None:
            return []
        return self.spark.read.schema(self.MANIFEST).parquet(f"{self.path}/manifests/v={v}").collect()  # buckets + queries rows

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return empty_frame(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{f}" for f in folders]).select(*self.schema.names)

    def read(self) -> DataFrame:
        return self._rows(sorted(r.folder for r in self._manifest() if r.bucket is not None))

    def upsert(self, batch: DataFrame, query: str, batch_id: int) -> None:
        manifest = self._manifest()
        if any(r.query == query and r.batch >= batch_id for r in manifest if r.bucket is None):
            return  # replay of a committed batch
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        batch = store(batch.select(*self.schema.names), "increment")  # looked at twice; a source may give it only once
        touched = {r[0] for r in batch.select(bucket.alias("b")).distinct().collect()}  # at most as many as buckets
        if not touched:
            return
        folders = {r.bucket: r.folder for r in manifest if r.bucket is not None}
        merged = merge_batch(self._rows(sorted(folders[b] for b in touched if b in folders)), batch, self.key, self.ordinal)
        write = uuid.uuid4().hex
        (merged.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{write}"))
        folders |= {b: f"{write}/bucket={b}" for b in touched}
        queries = {r.query: r.batch for r in manifest if r.bucket is None} | {query: batch_id}
        rows = [(b, f, None, None) for b, f in sorted(folders.items())] + [(None, None, q, n) for q, n in sorted(queries.items())]
        commit_version(self.spark.createDataFrame(rows, self.MANIFEST).coalesce(1), self.path, "manifests")


def stream_upsert_increments(spark: SparkSession, landing: str, glob: str, state: BucketedState, checkpoint: str, fmt: str = "parquet",
                             max_files_per_trigger: int | None = None, query_name: str = "stream") -> DataFrame:
    """L2: drain newly landed files into a ``BucketedState``, rewriting only the touched buckets; returns its rows."""
    reader = spark.readStream.schema(state.schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.format(fmt).load(landing)
    run_available_now(stream.writeStream.foreachBatch(lambda df, n: state.upsert(df, query_name, n)), checkpoint)
    return state.read()
