"""Writers and versioned commits.

A warehouse table is a folder of versions ``<base>/<table>/v=<n>``; a commit writes a new
version and the readers pick the highest. Nothing ever overwrites the folder being read, so
a failed or retried job leaves the previous version intact (idempotent by version number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import status_bucket
from ..operators.keys import default_tasks
from ..session import shuffles_freed
from .literals import empty_frame


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _version_folders(spark: SparkSession, base: str, table: str) -> list[int]:
    """Numbers of all version folders, half-written ones of a crashed commit included: one listing."""
    fs, p = _fs(spark, f"{base.rstrip('/')}/{table}")
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[2:]) for n in names if n.startswith("v="))


def _is_committed(spark: SparkSession, base: str, table: str, v: int) -> bool:
    fs, p = _fs(spark, f"{base.rstrip('/')}/{table}/v={v}/_SUCCESS")
    return fs.exists(p)


def list_versions(spark: SparkSession, base: str, table: str) -> list[int]:
    """Every committed version, oldest first (one look per version: for clean-up, not for loads)."""
    return [v for v in _version_folders(spark, base, table) if _is_committed(spark, base, table, v)]


def current_version(spark: SparkSession, base: str, table: str) -> int | None:
    """The newest committed version; looks only at folders newer than it and at itself."""
    return next((v for v in reversed(_version_folders(spark, base, table)) if _is_committed(spark, base, table, v)), None)


def next_version(spark: SparkSession, base: str, table: str) -> int:
    """One above every version folder, half-written ones of a crashed commit included."""
    return max(_version_folders(spark, base, table), default=0) + 1


def commit_version(df: DataFrame, base: str, table: str) -> int:
    """Write ``df`` as the next version of ``table``; returns the version number."""
    spark = df.sparkSession
    v = next_version(spark, base, table)
    df.write.mode("errorifexists").parquet(f"{base.rstrip('/')}/{table}/v={v}")
    return v


def read_current(spark: SparkSession, base: str, table: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Latest committed version of ``table`` (None, or an empty typed frame, when none)."""
    v = current_version(spark, base, table)
    if v is None:
        return empty_frame(spark, schema) if schema is not None else None
    return spark.read.parquet(f"{base.rstrip('/')}/{table}/v={v}")


def _table_name(table: str, version: int, base: str = "") -> str:
    """Catalog name of one committed version; the warehouse location is part of it, so two
    warehouses never share a name."""
    import hashlib
    tag = hashlib.sha1(base.rstrip("/").encode()).hexdigest()[:10]
    return "".join(ch if ch.isalnum() else "_" for ch in f"ll_{tag}_{table}_v{version}")


def commit_bucketed(df: DataFrame, base: str, table: str, keys: list[str], buckets: int) -> int:
    """Commit the next version bucketed (and sorted) by ``keys``, so later joins / upserts on
    the key read it already hash-partitioned: only the other side is shuffled. The bucket
    spec is recorded next to the data (``_bucket_spec.json``) so any session can register the
    version again (``read_bucketed``)."""
    import json
    spark = df.sparkSession
    v = next_version(spark, base, table)
    path = f"{base.rstrip('/')}/{table}/v={v}"
    (df.write.mode("errorifexists").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
       .option("path", path).saveAsTable(_table_name(table, v, base)))
    fs, p = _fs(spark, f"{path}/_bucket_spec.json")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps({"keys": keys, "buckets": buckets, "schema": df.schema.json()}).encode()))
    out.close()
    return v


def read_bucketed(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """Latest version of a bucketed table, registered with its bucket spec (no re-shuffle on
    key joins). Falls back to a plain read for versions written without a spec."""
    import json
    v = current_version(spark, base, table)
    if v is None:
        return None
    path = f"{base.rstrip('/')}/{table}/v={v}"
    fs, p = _fs(spark, f"{path}/_bucket_spec.json")
    if not fs.exists(p):
        return spark.read.parquet(path)
    stream = fs.open(p)
    raw = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    spec = json.loads(raw)
    name = _table_name(table, v, base)
    if not spark.catalog.tableExists(name):
        schema = T.StructType.fromJson(json.loads(spec["schema"]))
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in spec["keys"])
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {int(spec['buckets'])} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def reset_warehouse(spark: SparkSession, base: str, schemas: dict[str, T.StructType]) -> dict[str, int]:
    """Commit an empty typed version of every warehouse table (children and parents alike)."""
    return {name: commit_version(empty_frame(spark, schema), base, name) for name, schema in schemas.items()}


def write_json_wrapped(df: DataFrame, path: str, file_key, wrapper: str | None = None, order: list | None = None,
                       folders: list[str] | None = None, wrap_when=None) -> None:
    """Landed-style documents — one file per ``file_key`` value (inside ``folders``
    partition folders, if given) holding a JSON array of its records, or
    ``{wrapper: [...]}`` (for every file, or only where the ``wrap_when`` condition over the
    grouping columns holds), records sorted by ``order``. The caller picks a file key whose
    groups are bounded (e.g. ``id div 1000`` over unique ids): a document is built in one task,
    exactly as a reader parses one file in one task. One write job for all folders."""
    folders = folders or []
    rows = _rows_by_file(df, [*folders, file_key])
    docs = _documents(rows, file_key, wrapper, order, folders, wrap_when)
    docs.write.mode("overwrite").partitionBy(*folders, "file_key").text(path)


def write_entity_dir(df: DataFrame, path: str, slug: str = "slug", value: str = "value") -> None:
    """A2's layout: the text ``value`` of each entity in a file of its own in the folder ``<slug>=<entity's slug>``, as
    ``read_entity_dir`` reads it with ``slug_from_dir``."""
    _rows_by_file(df.select(slug, value), [slug]).write.mode("overwrite").partitionBy(slug).text(path)


def _rows_by_file(df: DataFrame, keys: list) -> DataFrame:
    """The rows of a file brought together. Writing small files takes time by their number, not by their bytes, so the
    number of tasks is given (the shuffle partitions): adaptive execution would put all of a few MB into one task."""
    return df.repartition(default_tasks(df), *keys)


def write_json_documents(df: DataFrame, path: str, document_key, wrapper: str | None = None, order: list | None = None,
                         folders: list[str] | None = None, wrap_when=None, tasks: int | None = None) -> None:
    """A6, bounded number of files: the documents of ``write_json_wrapped``, one per line, many to a file. Ranges of whole
    documents by ``document_key`` go to ``tasks`` tasks (the shuffle partitions if not given), so there are at most tasks x
    folders files, in the order of the key, and no folder per document. ``read_json_lines`` reads them back. The records
    are dealt out by range before they are grouped, so they move once and no documents after them."""
    folders = folders or []
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = _documents(df.repartitionByRange(tasks, document_key), document_key, wrapper, order, folders, wrap_when)
    out = docs.sortWithinPartitions(*folders, "file_key").select(*folders, "value")
    with shuffles_freed(df.sparkSession):
        (out.write.mode("overwrite").partitionBy(*folders) if folders else out.write.mode("overwrite")).text(path)


def _documents(df: DataFrame, file_key, wrapper: str | None, order: list | None, folders: list[str], wrap_when) -> DataFrame:
    """``folders``, file_key, value: a JSON array (or wrapper object) of each key's records."""
    key = F.col(file_key) if isinstance(file_key, str) else file_key
    skip = set(folders) | ({file_key} if isinstance(file_key, str) else set())
    cols = [c for c in df.columns if c not in skip and c not in folders]
    keys = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order or [])]
    recs = F.struct(*keys, *[F.col(c) for c in cols])
    docs = df.groupBy(*[F.col(f) for f in folders], key.alias("file_key")) \
        .agg(F.array_sort(F.collect_list(recs)).alias("_recs"))
    body = F.to_json(F.transform("_recs", lambda r: F.struct(*[r[c] for c in cols])))
    if wrapper:
        wrapped = F.concat(F.lit('{"' + wrapper + '":'), body, F.lit("}"))
        body = wrapped if wrap_when is None else F.when(wrap_when, wrapped).otherwise(body)
    return docs.select(*folders, "file_key", body.alias("value"))


def write_csv_union(df: DataFrame, path: str) -> None:
    """CSV with a header whose columns are the sorted union of keys."""
    df.select(*sorted(df.columns)).write.mode("overwrite").option("header", True).csv(path)


def write_by_status(df: DataFrame, path: str, status: str = "status") -> DataFrame:
    """Route rows into active / acquired / inactive / unknown folders; returns the skip
    log (unknown rows with their reason)."""
    routed = df.withColumn("status_bucket", status_bucket(F.col(status)))
    routed.write.mode("overwrite").partitionBy("status_bucket").json(path)
    return skip_log(routed, status)


def skip_log(routed: DataFrame, status: str = "status") -> DataFrame:
    reason = F.concat(F.lit("Unknown status: "),
                      F.lower(F.trim(F.coalesce(F.when(F.col(status) != "", F.col(status)), F.lit("Unknown")))))
    return routed.filter(F.col("status_bucket") == "unknown").withColumn("reason", reason)
