"""Validation with rejects kept, run outcomes and constraint audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import spread
from ..functions.core import truthy


def require_fields(df: DataFrame, cols: list[str], reason_col: str = "reason") -> tuple[DataFrame, DataFrame]:
    """B1: rows whose ``cols`` are all truthy, and the complement with a reason naming the
    first missing field. One scan feeds both sides when the caller caches or writes both."""
    checks = [(c, truthy(F.col(c), df.schema[c].dataType)) for c in cols]
    ok_expr = reduce(lambda a, b: a & b, [e for _, e in checks])
    reason = None
    for c, e in checks:
        reason = F.when(~e, F.lit(f"missing {c}")) if reason is None else reason.when(~e, F.lit(f"missing {c}"))
    ok = df.filter(ok_expr)
    rejects = df.filter(~ok_expr).withColumn(reason_col, reason)
    return ok, rejects


def reject_unknown_parent(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str,
                          reason: str = "unknown parent") -> tuple[DataFrame, DataFrame]:
    """B2: children whose parent key exists (semi join) and the rest (anti join) with a reason."""
    p = spread(parents.select(F.col(parent_key).alias("_pk")).distinct())
    cond = F.col(child_key) == F.col("_pk")
    kept = children.join(p, cond, "left_semi")
    rejected = children.join(p, cond, "left_anti").withColumn("reason", F.lit(reason))
    return kept, rejected


def run_outcomes(results: DataFrame, status: str = "status", reason: str = "reason") -> DataFrame:
    """Counts per (status, reason) — failures are rows, not exceptions."""
    return results.groupBy(status, reason).agg(F.count(F.lit(1)).alias("n"))


def unique_violations(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Duplicate non-NULL keys (NULL never conflicts in a unique index)."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (df.filter(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1)
              .select(F.lit(table).alias("table_name"), F.lit("unique(" + ",".join(keys) + ")").alias("rule"),
                      key_text.alias("key_value"), F.col("n").cast("long").alias("n")))


def fk_violations(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows with a non-NULL foreign key missing in the parent, counted per key value."""
    p = parent.select(F.col(pk).alias("_pk"))
    # counted before the join: a key that holds a third of the rows is one row by then
    counted = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
    return (counted.join(p, F.col(fk) == F.col("_pk"), "left_anti")
                   .select(F.lit(table).alias("table_name"), F.lit(f"fk({fk})").alias("rule"),
                           F.col(fk).cast("string").alias("key_value"), F.col("n").cast("long").alias("n")))


def not_null_violations(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """NULLs per required column, counted in one pass over the table; complete columns give no row."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    found = F.inline(F.array(*[F.struct(F.lit(f"not_null({c})").alias("rule"), F.col(c).alias("n")) for c in cols]))
    return (counts.select(found).filter(F.col("n") > 0)
                  .select(F.lit(table).alias("table_name"), "rule", F.lit(None).cast("string").alias("key_value"),
                          F.col("n").cast("long").alias("n")))


def audit_constraints(checks: list[DataFrame]) -> DataFrame:
    """H9: union of violation reports ``(table_name, rule, key_value, n)``."""
    return reduce(lambda a, b: a.unionByName(b), checks)


def audit_warehouse(wh: dict[str, DataFrame], required: dict, unique: dict, foreign: dict) -> DataFrame:
    """H9 over a whole warehouse: every required column, unique key and foreign key of its tables, as
    ``(table_name, rule, key_value, n)``.

    Every rule reads and moves its own key columns only, as they are: no row carries its rule's name or an array of key
    parts, and the counts run in generated code. Required columns are counted in one pass per table. Keys are counted before
    they move, so one that holds a third of the rows is a row by then; equal keys are told apart by their parts, not by their
    joined text. Keys are compared as text, whatever their types."""
    def keys_of(t, *cols):
        return wh[t].select(*[F.col(c).cast("string").alias(c) for c in cols])
    checks = []
    for t, df in wh.items():
        if required.get(t):
            checks.append(not_null_violations(df, t, required[t]))
        checks += [unique_violations(keys_of(t, *keys), t, keys) for keys in unique.get(t, [])]
        checks += [fk_violations(keys_of(t, c), t, c, keys_of(parent, pk), pk) for c, (parent, pk) in foreign.get(t, {}).items()]
    return audit_constraints(checks)
