"""Top-k and previews (F1–F3). The limits here are the feature itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: str, order: list, k: int = 10, rank_col: str = "rank") -> DataFrame:
    """first ``k`` rows per group under ``order`` (ties broken by the trailing order
    columns). ``row_number() <= k`` is planned with a partial ``WindowGroupLimit`` before the
    shuffle, so each map task forwards at most k rows per group."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_k(df: DataFrame, order: list, k: int = 10) -> DataFrame:
    """global top-k → ``TakeOrderedAndProject`` (each task keeps k, the driver merges k×tasks)."""
    return df.orderBy(*order).limit(k)


def top_counts(df: DataFrame, key: str, k: int = 10, out: str = "n") -> DataFrame:
    """the k most frequent keys, ties by key."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return top_k(counts, [F.col(out).desc(), F.col(key).asc()], k)


def preview(df: DataFrame, ordinal: str, cols: list[str], n: int = 5) -> DataFrame:
    """first ``n`` rows by ordinal, a few fields."""
    return df.orderBy(ordinal).limit(n).select(*cols)
