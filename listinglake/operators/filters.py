"""Predicates and projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_companies(df: DataFrame, status: str = "status") -> DataFrame:
    """Exact, case-sensitive ``status = 'Active'``."""
    return df.filter(F.col(status) == F.lit("Active"))


def missing_children(df: DataFrame, array_col: str, keep: list[str]) -> DataFrame:
    """Rows whose array is NULL or empty."""
    a = F.col(array_col)
    return df.filter(a.isNull() | (F.size(a) == 0)).select(*keep)


def split_by_has_jobs(df: DataFrame, count_col: str = "numJobs") -> tuple[DataFrame, DataFrame]:
    """``count > 0`` vs ``count = 0``; NULL lands in neither."""
    return df.filter(F.col(count_col) > 0), df.filter(F.col(count_col) == 0)


def like_token_regex(token: str) -> str:
    """A LIKE token as a Java regex found anywhere in the text: ``%`` → any run, ``_`` → any one
    character, everything else literal. ``(?i)`` without UNICODE_CASE folds only A–Z, exactly
    the store's LIKE; ``(?s)`` lets wildcards cross line breaks."""
    import re
    body = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in token)
    return "(?is)" + body


def keyword_predicate(query: str, cols: list[str] | None = None):
    """B8 predicate: split the query on single spaces; every token must occur in one of
    ``cols`` under LIKE semantics — ASCII-case-insensitive, '%' and '_' inside a token stay
    wildcards, an empty token matches any non-NULL value. One regex scan per token and
    column, no per-row copy of the text."""
    cols = cols or ["desc"]
    tokens = query.split(" ")
    per_token = [reduce(lambda a, b: a | b, [F.col(c).rlike(like_token_regex(t)) for c in cols]) for t in tokens]
    return reduce(lambda a, b: a & b, per_token)


def search_all_keywords(df: DataFrame, query: str, cols: list[str] | None = None) -> DataFrame:
    """Rows matching every token of ``query``."""
    return df.filter(keyword_predicate(query, cols))


def project_company_index(df: DataFrame, cols: tuple = ("id", "numJobs", "slug")) -> DataFrame:
    """The slim company index projection."""
    return df.select(*cols)


def sample_companies(df: DataFrame, n: int, seed: str, key: str = "id") -> DataFrame:
    """Seeded sample of ``min(n, count)`` rows without replacement: order by
    sha256(key || seed) and keep ``n`` (planned as a top-k, no full sort)."""
    h = F.sha2(F.concat(F.col(key).cast("string"), F.lit(seed)), 256)
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
