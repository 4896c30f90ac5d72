"""Half split of companies with their jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import spread
from .positions import global_position


def split_halves(companies: DataFrame, jobs: DataFrame, order: list, company_key: str,
                 job_key: str) -> DataFrame:
    """The first ⌈n/2⌉ companies (in ``order``) form half 'A', the rest 'B'; each job
    follows its company's key; jobs whose key has no company are 'orphan'. Returns the jobs
    with a ``half`` column, companies with theirs are available from ``company_halves``."""
    halves = company_halves(companies, order)
    # a repeated company key: its last position wins
    keys = spread(halves.groupBy(F.col(company_key).alias("_ck")).agg(F.max_by("half", "_pos").alias("_half")))
    return (jobs.join(keys, F.col(job_key).eqNullSafe(F.col("_ck")), "left")
                .withColumn("half", F.coalesce(F.col("_half"), F.lit("orphan")))
                .drop("_ck", "_half"))


def company_halves(companies: DataFrame, order: list) -> DataFrame:
    """Position every company exactly (no single-partition window) and label A / B."""
    pos = global_position(companies, order, name="_pos", total_name="_n")
    return (pos.withColumn("half", F.when(F.col("_pos") <= F.ceil(F.col("_n") / 2), F.lit("A")).otherwise(F.lit("B")))
               .drop("_n"))
