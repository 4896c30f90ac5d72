"""Profiling aggregates.

All are hash aggregates with a partial (map-side) phase, so a hot key is combined before
the shuffle. Dense category outputs join a fixed literal category list — bounded by the
rule table, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import truthy
from ..sources.literals import literal_frame
from ..functions.rules import EMPLOYER_CATEGORIES, STATUS_BUCKETS, employer_category, status_bucket


def refresh_num_jobs(company: DataFrame, jobs: DataFrame, company_id: str = "id", job_company: str = "companyId",
                     out: str = "numJobs") -> DataFrame:
    """Per-company job count, 0 when none (aggregate first, then a many-to-one left join)."""
    counts = jobs.groupBy(F.col(job_company).alias("_cid")).agg(F.count(F.lit(1)).alias("_n"))
    base = company.drop(out) if out in company.columns else company
    return (base.join(counts, F.col(company_id) == F.col("_cid"), "left")
                .withColumn(out, F.coalesce(F.col("_n"), F.lit(0)).cast("long"))
                .drop("_cid", "_n"))


def source_stats(companies: DataFrame, source: str = "source", num_jobs: str = "numJobs") -> DataFrame:
    """Per source — companies, Σ jobs (NULL ignored), with / without jobs (without =
    total − with), mean jobs per company (raw double; round at presentation)."""
    n = F.col(num_jobs)
    return (companies.groupBy(source)
                     .agg(F.count(F.lit(1)).alias("companies"),
                          F.sum(n).cast("long").alias("total_jobs"),
                          F.count_if(n > 0).alias("with_jobs"))
                     .withColumn("without_jobs", F.col("companies") - F.col("with_jobs"))
                     .withColumn("avg_jobs", F.coalesce(F.col("total_jobs"), F.lit(0)).cast("double") / F.col("companies")))


def jobs_per_company_stats(jobs: DataFrame, key: str) -> DataFrame:
    """D3: group by company key, then count / max / min / avg over the per-company counts."""
    per = jobs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.count(F.lit(1)).alias("companies"), F.max("_n").alias("max_jobs"),
                   F.min("_n").alias("min_jobs"), F.avg("_n").alias("avg_jobs"))


def counts_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def dense_counts(df: DataFrame, category_col, categories: list[str], name: str = "category",
                 total_label: str | None = "total") -> DataFrame:
    """Counts per category including zero rows, plus an optional total row."""
    spark = df.sparkSession
    counted = df.groupBy(category_col.alias(name) if not isinstance(category_col, str) else F.col(category_col).alias(name)) \
        .agg(F.count(F.lit(1)).alias("n"))
    # the category list is a fixed literal table, bounded by the rules
    cats = literal_frame(spark, [(c, i) for i, c in enumerate(categories)], f"{name} string, _ord int")
    dense = cats.join(counted, name, "left").select(
        name, F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
    if total_label is None:
        return dense
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")) \
        .select(F.lit(total_label).alias(name), "n")
    return dense.unionByName(total)


def count_by_category(df: DataFrame, company: str = "company") -> DataFrame:
    """Ordered substring rules → six employers + 'unknown', dense, plus the total."""
    return dense_counts(df, employer_category(F.col(company)), EMPLOYER_CATEGORIES)


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    """lower+trim status → active / acquired / inactive / unknown counts, dense."""
    return dense_counts(df, status_bucket(F.col(status)), STATUS_BUCKETS, name="status_bucket", total_label=None)


def skip_report(rejects: DataFrame, reason: str = "reject_reason", company: str = "company",
                url: str = "url") -> dict[str, DataFrame]:
    """Counts by reason; by company name (truthy names only); URL-checked and URL-missing."""
    return {
        "by_reason": rejects.groupBy(reason).agg(F.count(F.lit(1)).alias("n")),
        "by_company": rejects.filter(truthy(F.col(company))).groupBy(company).agg(F.count(F.lit(1)).alias("n")),
        "url_stats": rejects.agg(F.count(F.lit(1)).alias("total_skipped"),
                                 F.count_if(truthy(F.col(url))).alias("urls_checked"),
                                 F.count_if(~truthy(F.col(url))).alias("without_url")),
    }


def total_children(df: DataFrame, array_col: str, flag_col: str | None = None) -> DataFrame:
    """Σ array lengths (missing → 0), parents with ≥ 1 child, optional flag count."""
    a = F.col(array_col)
    aggs = [F.count(F.lit(1)).alias("parents"),
            F.coalesce(F.sum(F.when(a.isNotNull(), F.size(a)).otherwise(0)), F.lit(0)).cast("long").alias("children"),
            F.count_if(a.isNotNull() & (F.size(a) > 0)).alias("with_children")]
    if flag_col:
        aggs.append(F.count_if(F.coalesce(F.col(flag_col), F.lit(False))).alias("flagged"))
    return df.agg(*aggs)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(col).distinct()


def children_summary(df: DataFrame, count_col: str, flag_col: str | None = None) -> DataFrame:
    """D9 over a per-parent count column (the sampler's summary, B10): parents, Σ children,
    parents with ≥ 1 child, flagged parents."""
    n = F.col(count_col)
    aggs = [F.count(F.lit(1)).alias("parents"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("children"),
            F.count_if(n > 0).alias("with_children")]
    if flag_col:
        aggs.append(F.count_if(F.coalesce(F.col(flag_col), F.lit(False))).alias("flagged"))
    return df.agg(*aggs)
