"""Aggregate, filter and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.core import to_flag
from ..functions.text import slugify
from ..operators import aggregates as A
from ..operators import filters as B
from ..operators.joins import resolve_employer
from ..operators.topk import preview, top_per_group
from ..operators.validate import require_fields
from .catalog import query, table


def companies_with_counts(spark, sf):
    """customers as companies: source = nation name, numJobs = orders (NULL for the
    BUILDING segment, 0 when none)."""
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation").select(F.col("n_nationkey"), F.col("n_name").alias("source"))
    jobs = table(spark, sf, "orders")
    counted = A.refresh_num_jobs(c.select("c_custkey", "c_nationkey", "c_mktsegment"), jobs,
                                 company_id="c_custkey", job_company="o_custkey")
    return (counted.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                   .withColumn("numJobs", F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("long"))
                                           .otherwise(F.col("numJobs")))
                   .select("c_custkey", "source", "numJobs"))


_COMPANIES_SQL = """
WITH oc AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
c AS (SELECT c.c_custkey, n.n_name AS source,
             CASE WHEN c.c_mktsegment = 'BUILDING' THEN NULL ELSE coalesce(oc.n, 0) END AS numJobs
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN oc ON oc.o_custkey = c.c_custkey)
"""


@query("source_stats", _COMPANIES_SQL + """
SELECT source, count(*) AS companies, sum(numJobs) AS total_jobs, count_if(numJobs > 0) AS with_jobs,
       count(*) - count_if(numJobs > 0) AS without_jobs,
       CAST(coalesce(sum(numJobs), 0) AS DOUBLE) / count(*) AS avg_jobs
FROM c GROUP BY source""")
def source_stats(spark, sf):
    return A.source_stats(companies_with_counts(spark, sf))


@query("top_companies_per_source", _COMPANIES_SQL + """
SELECT * FROM (SELECT source, c_custkey, numJobs,
                      row_number() OVER (PARTITION BY source ORDER BY numJobs DESC NULLS LAST, c_custkey) AS rank
               FROM c) WHERE rank <= 10""")
def top_companies_per_source(spark, sf):
    return top_per_group(companies_with_counts(spark, sf), "source",
                         [F.col("numJobs").desc_nulls_last(), F.col("c_custkey")], 10) \
        .select("source", "c_custkey", "numJobs", "rank")


@query("num_jobs_refresh", """
SELECT c.c_custkey, coalesce(oc.n, 0) AS numJobs FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) oc
  ON oc.o_custkey = c.c_custkey""")
def num_jobs_refresh(spark, sf):
    jobs = table(spark, sf, "orders")
    return A.refresh_num_jobs(table(spark, sf, "customer").select("c_custkey"), jobs,
                              company_id="c_custkey", job_company="o_custkey")


@query("jobs_per_company_stats", """
SELECT count(*) AS companies, max(n) AS max_jobs, min(n) AS min_jobs, avg(n) AS avg_jobs
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)""")
def jobs_per_company_stats(spark, sf):
    return A.jobs_per_company_stats(table(spark, sf, "orders"), "o_custkey")


@query("jobs_per_source_counts", """
SELECT source, count(*) AS n FROM documents GROUP BY source""")
def jobs_per_source_counts(spark, sf):
    return A.counts_by(table(spark, sf, "documents"), "source")


# employer names derived from part sizes (identical CASE in the oracle)
_EMPLOYER_NAME_SQL = """CASE WHEN p_size <= 5 THEN 'Microsoft Corporation' WHEN p_size <= 10 THEN 'Apple Inc.'
 WHEN p_size <= 15 THEN 'Facebook' WHEN p_size <= 20 THEN 'META Platforms' WHEN p_size <= 25 THEN 'amazon'
 WHEN p_size <= 30 THEN 'Alphabet' WHEN p_size <= 35 THEN '' WHEN p_size <= 40 THEN NULL
 WHEN p_size <= 45 THEN 'Google Apple JV' ELSE p_name END"""


def _employer_names(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.expr(_EMPLOYER_NAME_SQL).alias("company"))


@query("category_counts", f"""
WITH j AS (SELECT {_EMPLOYER_NAME_SQL} AS company FROM part),
k AS (SELECT CASE WHEN company IS NULL OR company = '' THEN 'unknown'
                  WHEN lower(company) LIKE '%microsoft%' THEN 'microsoft'
                  WHEN lower(company) LIKE '%apple%' THEN 'apple'
                  WHEN lower(company) LIKE '%meta%' OR lower(company) LIKE '%facebook%' THEN 'meta'
                  WHEN lower(company) LIKE '%amazon%' THEN 'amazon'
                  WHEN lower(company) LIKE '%netflix%' THEN 'netflix'
                  WHEN lower(company) LIKE '%google%' OR lower(company) LIKE '%alphabet%' THEN 'google'
                  ELSE 'unknown' END AS category FROM j),
cats(category) AS (VALUES ('microsoft'), ('apple'), ('meta'), ('amazon'), ('netflix'), ('google'), ('unknown'))
SELECT cats.category, CAST(count(k.category) AS BIGINT) AS n FROM cats LEFT JOIN k ON k.category = cats.category
GROUP BY cats.category
UNION ALL SELECT 'total', count(*) FROM k""")
def category_counts(spark, sf):
    return A.count_by_category(_employer_names(spark, sf), "company")


_STATUS_SQL = "CASE o_orderstatus WHEN 'O' THEN ' Active ' WHEN 'F' THEN 'ACQUIRED' ELSE 'Paused' END"


@query("status_counts", f"""
WITH s AS (SELECT lower(trim(coalesce(nullif({_STATUS_SQL}, ''), 'Unknown'))) AS st FROM orders),
b AS (SELECT CASE WHEN st IN ('active', 'acquired', 'inactive') THEN st ELSE 'unknown' END AS status_bucket FROM s),
cats(status_bucket) AS (VALUES ('active'), ('acquired'), ('inactive'), ('unknown'))
SELECT cats.status_bucket, CAST(count(b.status_bucket) AS BIGINT) AS n
FROM cats LEFT JOIN b ON b.status_bucket = cats.status_bucket GROUP BY cats.status_bucket""")
def status_counts(spark, sf):
    return A.status_counts(table(spark, sf, "orders").select(F.expr(_STATUS_SQL).alias("status")))


_FLAT_COMPANY_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'amazon' WHEN '2-HIGH' THEN 'Google LLC'
 WHEN '3-MEDIUM' THEN '' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'NETFLIX' END"""
_FLAT_URL_SQL = """CASE WHEN o_orderstatus = 'F' THEN 'https://www.amazon.jobs/en/jobs/' || CAST(o_orderkey AS VARCHAR)
 WHEN o_orderstatus = 'O' THEN 'https://Careers.Google.com/jobs/' || CAST(o_orderkey AS VARCHAR)
 WHEN o_orderpriority = '3-MEDIUM' THEN 'https://example.org/jobs/' || CAST(o_orderkey AS VARCHAR)
 WHEN o_orderpriority = '2-HIGH' THEN '' ELSE NULL END"""


def flat_feed(spark, sf):
    """orders as the flat 7-column feed: id, title, desc, date, location, url, company."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("desc"),
        F.col("o_orderdate").cast("string").alias("date"), F.col("o_custkey").cast("string").alias("location"),
        F.expr(_FLAT_URL_SQL.replace("VARCHAR", "STRING")).alias("url"),
        F.expr(_FLAT_COMPANY_SQL).alias("company"))


_RESOLVE_SQL = f"""
WITH f AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, {_FLAT_COMPANY_SQL} AS company, {_FLAT_URL_SQL} AS url FROM orders),
r AS (SELECT id, company, url,
        CASE lower(company) WHEN 'amazon' THEN 'Amazon' WHEN 'apple' THEN 'Apple' WHEN 'google' THEN 'Google'
             WHEN 'meta' THEN 'Meta' WHEN 'microsoft' THEN 'Microsoft' WHEN 'netflix' THEN 'Netflix' END AS by_name,
        CASE WHEN url IS NULL OR url = '' THEN NULL
             WHEN lower(url) LIKE '%amazon.jobs%' THEN 'Amazon'
             WHEN lower(url) LIKE '%jobs.careers.microsoft.com%' THEN 'Microsoft'
             WHEN lower(url) LIKE '%careers.microsoft.com%' THEN 'Microsoft'
             WHEN lower(url) LIKE '%jobs.netflix.com%' THEN 'Netflix'
             WHEN lower(url) LIKE '%google.com%' THEN 'Google'
             WHEN lower(url) LIKE '%careers.google.com%' THEN 'Google'
             WHEN lower(url) LIKE '%apple.com/jobs%' THEN 'Apple'
             WHEN lower(url) LIKE '%careers.apple.com%' THEN 'Apple'
             WHEN lower(url) LIKE '%meta.com/careers%' THEN 'Meta'
             WHEN lower(url) LIKE '%metacareers.com%' THEN 'Meta'
             WHEN lower(url) LIKE '%facebook.com/careers%' THEN 'Meta'
             WHEN lower(url) LIKE '%instagram.com/careers%' THEN 'Meta' END AS by_url FROM f),
e AS (SELECT *, coalesce(by_name, by_url) AS employer,
        CASE WHEN by_name IS NOT NULL THEN 'company_name' WHEN by_url IS NOT NULL THEN 'url_pattern' END AS match_source,
        CASE WHEN coalesce(by_name, by_url) IS NOT NULL THEN NULL
             WHEN company IS NULL OR company = '' THEN 'No company name'
             ELSE 'Company not in FAANG list and URL not matching' END AS reject_reason FROM r)
"""


def resolved_feed(spark, sf):
    return resolve_employer(flat_feed(spark, sf), "company", "url")


@query("url_rule_match", _RESOLVE_SQL + "SELECT id, employer, match_source FROM e")
def url_rule_match(spark, sf):
    return resolved_feed(spark, sf).select("id", "employer", "match_source")


def _rejects(spark, sf):
    return resolved_feed(spark, sf).filter(F.col("employer").isNull())


@query("skip_report_reasons", _RESOLVE_SQL + "SELECT reject_reason, count(*) AS n FROM e WHERE employer IS NULL GROUP BY 1")
def skip_report_reasons(spark, sf):
    return A.skip_report(_rejects(spark, sf))["by_reason"]


@query("skip_report_companies", _RESOLVE_SQL + """
SELECT company, count(*) AS n FROM e WHERE employer IS NULL AND company IS NOT NULL AND company <> '' GROUP BY 1""")
def skip_report_companies(spark, sf):
    return A.skip_report(_rejects(spark, sf))["by_company"]


@query("skip_report_urls", _RESOLVE_SQL + """
SELECT count(*) AS total_skipped, count_if(url IS NOT NULL AND url <> '') AS urls_checked,
       count_if(url IS NULL OR url = '') AS without_url FROM e WHERE employer IS NULL""")
def skip_report_urls(spark, sf):
    return A.skip_report(_rejects(spark, sf))["url_stats"]


@query("require_fields", """
WITH c AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS segment,
                  CASE WHEN c_acctbal < 500 THEN 0.0 ELSE c_acctbal END AS acct FROM customer)
SELECT c_custkey,
       CASE WHEN c_name IS NULL OR c_name = '' THEN 'missing c_name'
            WHEN segment IS NULL OR segment = '' THEN 'missing segment'
            WHEN acct IS NULL OR acct = 0 OR isnan(acct) THEN 'missing acct' END AS reason,
       coalesce(acct <> 0 AND NOT isnan(acct), false) AS acct_flag
FROM c""")
def require_fields_q(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") < 500, F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("acct"))
    ok, rejects = require_fields(c, ["c_name", "segment", "acct"])
    both = ok.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects)
    return both.select("c_custkey", "reason", to_flag(F.col("acct"), c.schema["acct"].dataType).alias("acct_flag"))


_LONG_WORDS = r"[A-Za-z]{12,}"


def _turns_with_long_words(spark, sf):
    return table(spark, sf, "conversations").withColumn(
        "long_words", F.regexp_extract_all(F.col("text"), F.lit(_LONG_WORDS), 0))


_TURNS_SQL = r"""
WITH t AS (SELECT conv_id, turn, role, regexp_extract_all(text, '[A-Za-z]{12,}') AS long_words FROM conversations)
"""


@query("missing_children", _TURNS_SQL + "SELECT conv_id, turn, role FROM t WHERE long_words IS NULL OR len(long_words) = 0")
def missing_children_q(spark, sf):
    return B.missing_children(_turns_with_long_words(spark, sf), "long_words", ["conv_id", "turn", "role"])


@query("total_children", _TURNS_SQL + """
SELECT count(*) AS parents, CAST(coalesce(sum(len(long_words)), 0) AS BIGINT) AS children,
       count_if(len(long_words) > 0) AS with_children, count_if(role = 'user') AS flagged FROM t""")
def total_children_q(spark, sf):
    t = _turns_with_long_words(spark, sf).withColumn("is_user", F.col("role") == "user")
    return A.total_children(t, "long_words", "is_user")


@query("has_jobs_split", _TURNS_SQL + """
SELECT conv_id, turn, CASE WHEN len(long_words) > 0 THEN 'with' ELSE 'without' END AS bucket FROM t""")
def has_jobs_split(spark, sf):
    t = _turns_with_long_words(spark, sf).withColumn("numJobs", F.size("long_words"))
    with_, without = B.split_by_has_jobs(t, "numJobs")
    return with_.select("conv_id", "turn", F.lit("with").alias("bucket")).unionByName(
        without.select("conv_id", "turn", F.lit("without").alias("bucket")))


_ACTIVE_SQL = "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'active' ELSE 'Active ' END"


@query("active_filter", f"SELECT o_orderkey FROM orders WHERE ({_ACTIVE_SQL}) = 'Active'")
def active_filter(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(_ACTIVE_SQL).alias("status"))
    return B.active_companies(o).select("o_orderkey")


@query("company_index", r"""
SELECT s_suppkey AS id, coalesce(l.n, 0) AS numJobs,
       substring(regexp_replace(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), 1, 100) AS slug
FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey) l ON l.l_suppkey = s_suppkey""")
def company_index(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), slugify(F.col("s_name")).alias("slug"))
    counted = A.refresh_num_jobs(s, table(spark, sf, "lineitem"), company_id="id", job_company="l_suppkey")
    return B.project_company_index(counted)


@query("keyword_search", """
SELECT doc_id FROM documents
WHERE translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') LIKE '%the%'
  AND translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') LIKE '%and%'""")
def keyword_search(spark, sf):
    return B.search_all_keywords(table(spark, sf, "documents"), "The and", ["text"]).select("doc_id")


@query("sample_companies", """
SELECT c_custkey, c_name FROM customer ORDER BY sha256(CAST(c_custkey AS VARCHAR) || 'seed42'), c_custkey LIMIT 25""")
def sample_companies(spark, sf):
    return B.sample_companies(table(spark, sf, "customer"), 25, "seed42", key="c_custkey").select("c_custkey", "c_name")


@query("preview", "SELECT s_suppkey, s_name, s_nationkey FROM supplier ORDER BY s_suppkey LIMIT 5")
def preview_q(spark, sf):
    return preview(table(spark, sf, "supplier"), "s_suppkey", ["s_suppkey", "s_name", "s_nationkey"], 5)


@query("sample_summary", """
WITH s AS (SELECT c_custkey, c_mktsegment FROM customer
           ORDER BY sha256(CAST(c_custkey AS VARCHAR) || 'seed42'), c_custkey LIMIT 25),
oc AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT count(*) AS parents, CAST(coalesce(sum(coalesce(oc.n, 0)), 0) AS BIGINT) AS children,
       count_if(coalesce(oc.n, 0) > 0) AS with_children, count_if(s.c_mktsegment = 'BUILDING') AS flagged
FROM s LEFT JOIN oc ON oc.o_custkey = s.c_custkey""")
def sample_summary(spark, sf):
    """B10 + D9: the seeded sample of companies and the summary of their jobs."""
    sample = B.sample_companies(table(spark, sf, "customer"), 25, "seed42", key="c_custkey") \
        .select("c_custkey", (F.col("c_mktsegment") == "BUILDING").alias("flag"))
    # the sample holds at most 25 rows (a limit), so broadcasting its keys is bounded; only the
    # sampled companies' jobs reach the aggregate
    jobs = table(spark, sf, "orders").join(F.broadcast(sample.select(F.col("c_custkey").alias("o_custkey"))),
                                           "o_custkey", "left_semi")
    counted = A.refresh_num_jobs(sample, jobs, company_id="c_custkey", job_company="o_custkey")
    return A.children_summary(counted, "numJobs", "flag")
