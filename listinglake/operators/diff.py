"""Snapshot comparison (C7) and its counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import truthy
from .dedupe import last_wins


def compare_snapshots(a: DataFrame, b: DataFrame, id_col: str = "id", url: str = "url",
                      company: str = "company", b_order: str | None = None) -> DataFrame:
    """One row per classified record ``(kind, id, other_id, company)``:

    * ``by_id``   — a and b share the id,
    * ``by_url``  — a row not matched by id whose truthy url is in b (the last b row per url
      wins, as a url index built by overwriting would),
    * ``only_a``  — a rows matched neither way,
    * ``only_b``  — b rows whose id is not in a and whose truthy url is not in a.
    """
    a_ = a.select(F.col(id_col).alias("a_id"), F.col(url).alias("a_url"), F.col(company).alias("a_company"))
    b_ = b.select(F.col(id_col).alias("b_id"), F.col(url).alias("b_url"), F.col(company).alias("b_company"),
                  F.col(b_order or id_col).alias("_ord"))
    # a side: one left join classifies by id, a second one (on the unmatched rest) by url
    b_ids = b_.select(F.col("b_id").alias("_bid")).distinct().withColumn("_in_b", F.lit(True))
    a_flag = a_.join(b_ids, F.col("a_id") == F.col("_bid"), "left")
    by_id = a_flag.filter(F.col("_in_b").isNotNull())
    rest_a = a_flag.filter(F.col("_in_b").isNull())
    b_url_index = last_wins(b_.filter(truthy(F.col("b_url"))), "b_url", ["_ord"]).select("b_url", "b_id")
    rest_a = rest_a.join(b_url_index, truthy(F.col("a_url")) & (F.col("a_url") == F.col("b_url")), "left")
    # b side: rows whose id and truthy url are both unknown to a
    a_ids = a_.select(F.col("a_id").alias("_aid")).distinct()
    a_urls = a_.filter(truthy(F.col("a_url"))).select(F.col("a_url").alias("_aurl")).distinct()
    only_b = (b_.join(a_ids, F.col("b_id") == F.col("_aid"), "left_anti")
                .join(a_urls, F.col("b_url") == F.col("_aurl"), "left_anti"))
    null_id = F.lit(None).cast(a_.schema["a_id"].dataType)
    return (by_id.select(F.lit("by_id").alias("kind"), F.col("a_id").alias("id"), F.col("a_id").alias("other_id"),
                         F.col("a_company").alias("company"))
            .unionByName(rest_a.select(F.when(F.col("b_id").isNotNull(), F.lit("by_url")).otherwise(F.lit("only_a"))
                                        .alias("kind"), F.col("a_id").alias("id"),
                                       F.col("b_id").cast(a_.schema["a_id"].dataType).alias("other_id"),
                                       F.col("a_company").alias("company")))
            .unionByName(only_b.select(F.lit("only_b").alias("kind"), F.col("b_id").alias("id"),
                                       null_id.alias("other_id"), F.col("b_company").alias("company"))))


def diff_counts(diff: DataFrame) -> DataFrame:
    """Counts per (kind, company), falsy company → 'Unknown', plus one total row per kind
    (company = NULL)."""
    comp = F.when(truthy(F.col("company")), F.col("company")).otherwise(F.lit("Unknown"))
    return diff.withColumn("company", comp).rollup("kind", "company").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("kind").isNotNull())
