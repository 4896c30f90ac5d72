"""Small literal tables built inside the JVM (no Python RDD, no Python worker).

Rule lists, seed names, registries and empty typed states are tiny and fixed in size; building
them from ``spark.range`` + ``inline`` keeps every plan free of Python scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def empty_frame(spark: SparkSession, schema) -> DataFrame:
    """A typed empty table that Catalyst knows is empty (a ``false`` filter folds to an empty
    local relation), so joins and unions with it are simplified away instead of planned."""
    s = _schema(schema)
    out = spark.range(1).selectExpr(*[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in s.fields]) \
        .where("false")
    out._empty = True
    return out


def known_empty(df: DataFrame) -> bool:
    """Whether ``empty_frame`` made it."""
    return getattr(df, "_empty", False)


def literal_frame(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    s = _schema(schema)
    if not rows:
        return empty_frame(spark, s)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, s.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
