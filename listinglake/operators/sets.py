"""Set operations and dimension building."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import truthy
from ..functions.text import surrogate_id


def union_distinct(frames: list[DataFrame], col: str) -> DataFrame:
    """G1: distinct values of ``col`` across frames (each side pre-deduplicated map-side)."""
    parts = [f.select(F.col(col)).filter(F.col(col).isNotNull()) for f in frames]
    return reduce(lambda a, b: a.union(b), parts).distinct()


def build_dimension(staged: DataFrame, key: str, id_col: str = "id", out_key: str | None = None) -> DataFrame:
    """Distinct truthy names → reproducible surrogate id (sha256 of the name)."""
    out_key = out_key or key
    return (staged.select(F.col(key).alias(out_key)).filter(truthy(F.col(out_key))).distinct()
                  .withColumn(id_col, surrogate_id(out_key)))


def concat_arrays(a, b):
    """``[...a, ...b]`` with falsy elements removed (duplicates kept)."""
    ac = F.col(a) if isinstance(a, str) else a
    bc = F.col(b) if isinstance(b, str) else b
    both = F.concat(F.coalesce(ac, F.array().cast("array<string>")), F.coalesce(bc, F.array().cast("array<string>")))
    return F.filter(both, lambda x: truthy(x))


def union_all_sources(frames: list[DataFrame]) -> DataFrame:
    """Append rows of all sources by column name; missing columns become NULL."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
