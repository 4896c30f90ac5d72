"""Registered queries: the operators bound to the driver's tables, each with a DuckDB oracle.

Role bindings (every query reads whole tables):
* ``documents`` is a job feed: source = ``source``, employer domain = ``lang``,
  title = md5(text), ordinal = ``doc_id``;
* ``pages`` is a company feed: domain = URL host, source = the language path segment;
* ``customer`` / ``supplier`` are companies, ``orders`` / ``lineitem`` jobs and salaries,
  ``c_mktsegment`` markets, ``nation`` offices, ``region`` stages, ``part`` founders,
  ``events`` a flat feed / stream.
Values the feeds need but the tables lack (missing names, empty urls, zeros) are derived
with the same CASE expressions in the Spark plan and in the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


from . import q_dedupe, q_stats, q_joins, q_merge, q_scalar, q_io, q_directory, q_unify, q_landing, q_held  # noqa: E402,F401  (registration)
