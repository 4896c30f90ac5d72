"""Mixing sources to target weights (operator 9) by Poisson replication.

Every source gets a mean repetition rate: its share of the target size over what it has. A
document's count is the inverse Poisson distribution function of that rate at a number hashed from
the seed, its doc_id and its text; the document is exploded by its count, and the copies go to a
random order: partitioned and sorted by the hash of (seed, row key, copy).

Rates above ``PART`` are split into equal parts, each with a hashed number of its own; the sum of
the parts has the same distribution, and no probability underflows.

Defined results: a null source is a source like any other; null text counts as empty; a source
without any characters, or with weight 0, gives no rows; repeated rows get equal counts; an empty
table gives no rows; a column named like the copy number is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, stored

PART = 500.0


def repetition_rates(docs: DataFrame, weights: dict[str | None, float] | None = None,
                     total_chars: float | None = None) -> DataFrame:
    """source, rate, parts, cdf. Without weights all sources weigh the same; without a total the mix
    is as large as the input."""
    sizes = docs.groupBy(F.col("source").cast("string").alias("source")).agg(
        F.sum(F.length(F.coalesce(F.col("text"), F.lit("")))).alias("chars"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        rows = [(None if s is None else str(s), float(w)) for s, w in weights.items()]
        given = docs.sparkSession.createDataFrame(rows, "w_source string, weight double")
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("w_source")), "left").fillna(0.0, ["weight"])
    sizes = stored(sizes.select("source", "chars", "weight"), "source-sizes")
    used = sizes.filter("weight > 0 and chars > 0")
    all_weight, all_chars = used.agg(F.sum("weight"), F.sum("chars").cast("double")).first()  # one row
    size = F.lit(all_chars if total_chars is None else float(total_chars)).cast("double")
    rated = used.select("source", (size * F.col("weight") / F.lit(all_weight).cast("double") / F.col("chars")).alias("rate"))
    rated = rated.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
    lam = f"(rate / parts)"
    return rated.withColumn("cdf", F.expr(f"""
        aggregate(sequence(1, cast(ceil({lam} + 12 * sqrt({lam}) + 30) as int)),
                  named_struct('p', exp(-{lam}), 'c', array(exp(-{lam}))),
                  (s, k) -> named_struct('p', s.p * {lam} / k, 'c', s.c || array(element_at(s.c, -1) + s.p * {lam} / k)),
                  s -> s.c)"""))


def poisson_count(seed: int) -> Column:
    """Count of a row that has doc_id, _text (md5 of the text), parts and cdf."""
    return F.expr(f"""
        aggregate(sequence(0, parts - 1), 0L, (n, j) -> n + size(filter(cdf, c -> c <=
            cast(conv(substr(md5(concat_ws(':', '{int(seed)}', cast(j as string), coalesce(cast(doc_id as string), ''), _text)), 1, 13), 16, 10) as bigint)
            / 4503599627370496D)))""")


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, total_chars: float | None = None,
                seed: int = 17, copy_column: str = "copy") -> DataFrame:
    """The mixed documents in random order: the input's columns and the copy number, from 1."""
    rates = stored(repetition_rates(docs, weights, total_chars), "source-rates").withColumnRenamed("source", "r_source")
    rows = packed(docs).withColumn("_text", F.md5(F.coalesce(F.col("_doc.text"), F.lit("")).cast("binary")))
    counted = (rows.join(rates, F.col("_doc.source").cast("string").eqNullSafe(F.col("r_source")))
               .select("_doc", "doc_id", "_th", poisson_count(seed).alias("n")).filter("n > 0"))
    copies = counted.select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy_no"), "doc_id", "_th")
    order = F.xxhash64(F.lit(int(seed)), "doc_id", "_th", "copy_no")
    shuffled = copies.select("_doc", "copy_no", order.alias("_order")).repartition("_order").sortWithinPartitions("_order")
    keep = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns if c != copy_column]
    return shuffled.select(*keep, F.col("copy_no").alias(copy_column))
