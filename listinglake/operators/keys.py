"""NULL-safe join keys as columns, and the exchange that lets a hot key be split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DEFAULTS = {
    T.StringType: "", T.LongType: 0, T.IntegerType: 0, T.ShortType: 0, T.ByteType: 0,
    T.DoubleType: 0.0, T.FloatType: 0.0, T.BooleanType: False, T.DateType: "1970-01-01",
}


def _default(dtype: T.DataType):
    for t, v in _DEFAULTS.items():
        if isinstance(dtype, t):
            return F.lit(v).cast(dtype)
    return None


def _comparable(k: str, dtype: T.DataType):
    """Key as a non-NULL value: the type's default for NULL, or a text form for types without one."""
    d = _default(dtype)
    if d is not None:
        return F.coalesce(F.col(k), d)
    if isinstance(dtype, T.BinaryType):
        text = F.hex(F.col(k))
    elif isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(F.struct(F.col(k)))
    else:
        text = F.col(k).cast("string")
    return F.coalesce(text, F.lit(""))


def short_id(name: str) -> Column:
    """An id as bytes to join by, equal where the ids are: 33 for a sha256 in hex, whose 64 characters no shuffle codec
    makes less of, else a zero byte and the text."""
    c = F.col(name)
    return (F.when(c.rlike("\\A[0-9a-f]{64}\\z"), F.concat(F.unhex(F.lit("01")), F.unhex(c)))
             .otherwise(F.concat(F.unhex(F.lit("00")), F.encode(c, "UTF-8"))))


def default_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """A one-row-per-key side with an exchange of its own. An aggregate is already partitioned by
    the join key, so the join would shuffle only the other side and adaptive execution could not
    split a hot key; behind a round-robin exchange the join shuffles both sides, and it can."""
    return df.repartition(tasks or default_tasks(df))


def with_null_safe_keys(df: DataFrame, keys: list[str], prefix: str = "_nk", always: bool = False) -> tuple[DataFrame, list[str]]:
    """Add ``{prefix}{i}v`` / ``{prefix}{i}n`` columns for each key; returns (frame, column names).
    ``always`` also for keys that are never NULL, where the two sides of a join must agree."""
    out, names = df, []
    for i, k in enumerate(keys):
        if not always and not df.schema[k].nullable:
            names.append(k)  # never NULL: the key itself is already NULL-safe
            continue
        out = out.withColumn(f"{prefix}{i}v", _comparable(k, df.schema[k].dataType)).withColumn(f"{prefix}{i}n", F.col(k).isNull())
        names += [f"{prefix}{i}v", f"{prefix}{i}n"]
    return out, names
