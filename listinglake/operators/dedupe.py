"""Dedupe family: first-wins / last-wins / DISTINCT ON, duplicate log and summary.

Plan shapes:
* winner selection is ``row_number() = 1`` over a key window: Spark plans a *partial*
  ``WindowGroupLimit`` before the shuffle, so each map task forwards at most one row per key
  — a key holding a third of the data is cut down map-side before it moves;
* the duplicate log never sorts a whole key group in one task: winners are found with a
  partial aggregate (one row per key) and joined back; AQE's skew-join splitting handles a hot
  key on the big side of that many-to-one join;
* summaries come from one partial aggregate per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import spread, with_null_safe_keys
from .positions import position_within

KEY = "_key"


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _with_key(df: DataFrame, key) -> tuple[DataFrame, list[str], bool]:
    """Allow the key to be column names or one computed Column."""
    if isinstance(key, Column):
        return df.withColumn(KEY, key), [KEY], True
    keys = [key] if isinstance(key, str) else list(key)
    return df, keys, False


def first_wins(df: DataFrame, key, order: list) -> DataFrame:
    """Keep the first row per key under ``order`` (a total order: end it with a
    unique column). NULL keys form one group, as a JS Map keyed by the missing value does."""
    d, keys, tmp = _with_key(df, key)
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    out = d.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return out.drop(KEY) if tmp else out


def last_wins(df: DataFrame, key, ordinal: list) -> DataFrame:
    """``Map.set`` overwrite — the row with the greatest ordinal per key survives."""
    return first_wins(df, key, [F.col(c).desc() if isinstance(c, str) else c.desc() for c in ordinal])


def distinct_on(df: DataFrame, key, order: list) -> DataFrame:
    """PostgreSQL ``DISTINCT ON (key) ... ORDER BY key, order``. Spell NULL placement in
    ``order`` explicitly (PostgreSQL puts NULLs first under DESC)."""
    return first_wins(df, key, order)


def source_rank(source_col, ordered_sources: list[str]) -> Column:
    """Declared source order → 0-based rank; unknown sources sort after all known ones."""
    c = F.col(source_col) if isinstance(source_col, str) else source_col
    expr = F.lit(len(ordered_sources))
    for i, s in reversed(list(enumerate(ordered_sources))):
        expr = F.when(c == F.lit(s), F.lit(i)).otherwise(expr)
    return expr


def domain_key(domain="domain", fallback="companyDomain") -> Column:
    """E1 key: ``domain || companyDomain`` — the fallback is taken as it is whenever the domain
    is falsy (so '' stays a key of its own and a missing value is the NULL key)."""
    d = F.col(domain)
    return F.when(F.coalesce(d != F.lit(""), F.lit(False)), d).otherwise(F.col(fallback))


def job_key(domain="companyDomain", title="title") -> Column:
    """E2 key: lower('<domain>_<title>') with a missing part printed as 'undefined'."""
    return F.lower(F.concat(F.coalesce(F.col(domain), F.lit("undefined")), F.lit("_"),
                            F.coalesce(F.col(title), F.lit("undefined"))))


def _winners(d: DataFrame, keys: list[str], order_struct: Column, payload: dict[str, Column]) -> DataFrame:
    """One row per key: the minimal order struct plus payload fields of that row (partial agg)."""
    packed = F.struct(order_struct.alias("o"), *[v.alias(k) for k, v in payload.items()])
    return d.groupBy(*keys).agg(F.min(packed).alias("_w"))


def duplicates_log(df: DataFrame, key, order_cols: list[str], source: str) -> DataFrame:
    """Every losing row with the winner's source and its own source.

    ``order_cols`` are ascending columns forming a total order (e.g. source rank, file, pos).
    Winners come from a partial aggregate (one row per key); the join back is many-to-one on
    NULL-safe key columns; the winners get an exchange of their own, so a hot key is split.
    """
    d, keys, tmp = _with_key(df, key)
    d, nk = with_null_safe_keys(d, keys, "_dk")
    order_struct = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)])
    winners = _winners(d, nk, order_struct, {"winner_source": F.col(source)})
    joined = d.join(spread(winners), nk)
    out = (joined.filter(order_struct != F.col("_w.o"))
                 .withColumn("winner_source", F.col("_w.winner_source"))
                 .withColumn("duplicate_source", F.col(source))
                 .drop("_w", *[c for c in nk if c.startswith("_dk")]))
    return out.drop(KEY) if tmp else out


def dedupe_summary(df: DataFrame, key) -> DataFrame:
    """Processed / unique / duplicate totals (one row), from one partial aggregate."""
    d, keys, _ = _with_key(df, key)
    per_key = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("processed"),
                       F.count(F.lit(1)).cast("long").alias("unique")) \
        .withColumn("duplicates", F.col("processed") - F.col("unique"))


def with_ordinal(df: DataFrame, group_cols: list[str], order_cols: list, name: str = "ordinal") -> DataFrame:
    """E5: 1-based position of each row inside its file/source, skew-safe (no single-task
    window over a hot group; see ``positions``)."""
    return position_within(df, group_cols, order_cols, name=name)
