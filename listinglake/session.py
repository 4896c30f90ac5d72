"""Session construction and the few session-level settings the operators rely on.

Operators never create sessions themselves; they take DataFrames. This module is for
entry points (bench, tests, streaming jobs) and for locating the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants regardless of cluster size: UTC everywhere (the warehouse stores
# UTC timestamps), adaptive execution with skew-join splitting and partition coalescing, and
# no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide plans are built by thousands of column calls; noting the call site of each takes a third of that time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "listinglake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (reliable checkpoints, versioned tables).

    On a cluster this is whatever ``spark.checkpoint.dir`` names, and it must be set: executors
    cannot see a temp folder of the driver. In local mode one is made if it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="listinglake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for materialised intermediate tables."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for what runs inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_freed(spark: SparkSession):
    """A write inside drops its shuffle files when it ends. Nothing reads them again, as every write plans shuffles of its
    own, but Spark keeps them on the executors' disks until the driver happens to collect its garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def store(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table once, columnar, to the shared folder and read it back: cuts the lineage of a state that several
    later plans use, survives lost executors, and lets these plans read only the columns they need.
    A frame that this function returned is stored already and comes back as it is. ``compression``: the Parquet codec, the
    session's if not given."""
    if getattr(df, "_stored", False):
        return df
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored = True
    return out


def stored_columns(table: DataFrame, columns: list[str]) -> DataFrame:
    """Some columns of a stored table; they are stored with it."""
    out = table.select(*columns)
    out._stored = getattr(table, "_stored", False)
    return out
