"""Dedupe-family queries (E1–E6, D5) and the flagship (E2 → D4 → F2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import extract_domain
from ..operators import dedupe as D
from ..operators.topk import top_counts
from .catalog import query, table

# Declared source order of the job feed (src0 … src19) and of the company feed.
JOB_SOURCES = [f"src{i}" for i in range(20)]
COMPANY_SOURCES = ["en", "fr", "de", "es"]


def job_feed(spark, sf):
    """documents as landed jobs: source, employer domain (= lang), title (= md5 of the text)."""
    return (table(spark, sf, "documents")
            .select("doc_id", "source", F.col("lang").alias("companyDomain"), F.md5("text").alias("title"))
            .withColumn("source_rank", D.source_rank("source", JOB_SOURCES)))


def company_feed(spark, sf):
    """pages as landed companies: host domain, source = language path segment, ordinal = page_id."""
    seg = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/([a-z]{2})/", 1)
    return (table(spark, sf, "pages")
            .select("page_id", extract_domain(F.col("url")).alias("domain"),
                    F.lit(None).cast("string").alias("companyDomain"), seg.alias("source"))
            .withColumn("source_rank", D.source_rank("source", COMPANY_SOURCES)))


_JOBS_SQL = """
WITH j AS (SELECT doc_id, source, lang AS companyDomain, md5(text) AS title,
                  CAST(substr(source, 4) AS INTEGER) AS source_rank FROM documents),
r AS (SELECT *, lower(coalesce(companyDomain, 'undefined') || '_' || coalesce(title, 'undefined')) AS k FROM j),
w AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY source_rank, doc_id) AS rn,
             first_value(source) OVER (PARTITION BY k ORDER BY source_rank, doc_id) AS winner_source FROM r)
"""


@query("jobs_first_wins", _JOBS_SQL + "SELECT doc_id, source, companyDomain, title FROM w WHERE rn = 1")
def jobs_first_wins(spark, sf):
    jobs = job_feed(spark, sf)
    return D.first_wins(jobs, D.job_key(), ["source_rank", "doc_id"]).select("doc_id", "source", "companyDomain", "title")


@query("jobs_duplicates_log", _JOBS_SQL + "SELECT doc_id, winner_source, source AS duplicate_source FROM w WHERE rn > 1")
def jobs_duplicates_log(spark, sf):
    jobs = job_feed(spark, sf)
    return D.duplicates_log(jobs, D.job_key(), ["source_rank", "doc_id"], "source") \
        .select("doc_id", "winner_source", "duplicate_source")


@query("jobs_dedupe_summary", _JOBS_SQL + """
SELECT count(*) AS processed, count(DISTINCT k) AS "unique", count(*) - count(DISTINCT k) AS duplicates FROM w""")
def jobs_dedupe_summary(spark, sf):
    return D.dedupe_summary(job_feed(spark, sf), D.job_key())


@query("unique_jobs_top_domains", _JOBS_SQL + """
SELECT companyDomain, count(*) AS n FROM w WHERE rn = 1 GROUP BY companyDomain ORDER BY n DESC, companyDomain LIMIT 10""")
def unique_jobs_top_domains(spark, sf):
    """Flagship: unique jobs per employer after cross-source first-wins dedupe, top 10."""
    unique = D.first_wins(job_feed(spark, sf), D.job_key(), ["source_rank", "doc_id"])
    return top_counts(unique, "companyDomain", 10)


@query("companies_first_wins", """
WITH p AS (SELECT page_id,
                  regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#@]*)', 1)), 'www\\.', '') AS domain,
                  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/([a-z]{2})/', 1) AS source FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY domain
                ORDER BY CASE source WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 WHEN 'es' THEN 3 ELSE 4 END,
                         page_id) AS rn FROM p)
SELECT page_id, domain, source FROM r WHERE rn = 1""")
def companies_first_wins(spark, sf):
    feed = company_feed(spark, sf)
    return D.first_wins(feed, D.domain_key(), ["source_rank", "page_id"]).select("page_id", "domain", "source")


@query("last_wins_dim", """
SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
       arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def last_wins_dim(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return D.last_wins(ev, "user_id", ["event_id"])


@query("job_ordinals", """
SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS ordinal FROM documents""")
def job_ordinals(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return D.with_ordinal(docs, ["source"], ["doc_id"])


_SALARY_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"]


@query("salary_distinct_on", """
WITH s AS (SELECT *, nullif(l_discount, 0) AS min_value FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY min_value DESC NULLS FIRST, """ +
       ", ".join(_SALARY_ORDER) + """) AS rn FROM s)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, min_value FROM r WHERE rn = 1""")
def salary_distinct_on(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("min_value", F.nullif(F.col("l_discount"), F.lit(0.0)))
    order = [F.col("min_value").desc_nulls_first()] + [F.col(c).asc() for c in _SALARY_ORDER]
    return D.distinct_on(li, "l_orderkey", order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "min_value")
