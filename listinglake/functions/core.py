"""Truthiness and defaulting.

The landed records follow loose-typing rules: a value "counts" when it is not NULL, not the
empty string, not 0 / 0.0 / NaN and not false. Every helper here is a plain Catalyst
expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c, dtype: T.DataType | None = None) -> Column:
    """Non-null boolean: does the value count as present?

    ``dtype`` picks the rule: strings must be non-empty ('0' and ' ' are truthy), numbers
    non-zero and not NaN, booleans true; arrays, maps and structs only need to be non-null
    (an empty list is still an object). Without ``dtype`` the column is treated as a string.
    """
    c = _col(c)
    dtype = dtype or T.StringType()
    if isinstance(dtype, T.BooleanType):
        out = c
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        out = (c != F.lit(0.0)) & ~F.isnan(c)
    elif isinstance(dtype, _NUMERIC):
        out = c != F.lit(0)
    elif isinstance(dtype, T.StringType):
        out = c != F.lit("")
    else:
        out = c.isNotNull()
    return F.coalesce(out, F.lit(False))


def truthy_of(df: DataFrame, name: str) -> Column:
    """``truthy`` with the type taken from the DataFrame's schema."""
    return truthy(F.col(name), df.schema[name].dataType)


def or_default(c, default, dtype: T.DataType | None = None) -> Column:
    """``c || default``: keep c when truthy, otherwise the default (plain coalesce is wrong:
    it would keep '' and 0)."""
    default = default if isinstance(default, Column) else F.lit(default)
    return F.when(truthy(c, dtype), _col(c)).otherwise(default)


def or_null(c, dtype: T.DataType | None = None) -> Column:
    """``c || null``: falsy values become NULL."""
    return F.when(truthy(c, dtype), _col(c))


def to_flag(c, dtype: T.DataType | None = None) -> Column:
    """``!!c`` — never NULL."""
    return truthy(c, dtype)


def completeness(cols: list, df: DataFrame | None = None) -> Column:
    """Number of present fields per row (D13). Here only NULL and '' count as missing; 0 and
    false are present."""
    parts = []
    for c in cols:
        col = _col(c)
        is_str = df is not None and isinstance(c, str) and isinstance(df.schema[c].dataType, T.StringType)
        present = (col.isNotNull() & (col != F.lit(""))) if (is_str or df is None) else col.isNotNull()
        parts.append(F.when(F.coalesce(present, F.lit(False)), F.lit(1)).otherwise(F.lit(0)))
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0)
