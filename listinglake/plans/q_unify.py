"""All three feeds into one warehouse (K6): the portfolio feed from customer / orders, the
flat feed from orders, the directory feed from supplier — in that order, each later feed
seeing the earlier rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import query, table
from .q_merge import _IMPORT_COMPANY_SQL, _IMPORT_URL_SQL, _landed_portfolio
from .q_directory import AS_OF, directory_inputs


def _flat_feed(spark, sf, location=None):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("desc"),
        F.col("o_orderdate").cast("string").alias("date"),
        (F.lit(None) if location is None else location).cast("string").alias("location"),
        F.expr(_IMPORT_URL_SQL.replace("VARCHAR", "STRING")).alias("url"), F.expr(_IMPORT_COMPANY_SQL).alias("company"))


@query("unified_state", f"""
WITH portfolio AS (
  SELECT 'portfolio' AS feed, (SELECT count(*) FROM customer) AS companies,
         (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)) AS jobs),
f AS (SELECT o_orderkey, {_IMPORT_URL_SQL} AS url, {_IMPORT_COMPANY_SQL} AS company FROM orders),
r AS (SELECT o_orderkey, url, coalesce(
        CASE lower(company) WHEN 'amazon' THEN 'Amazon' WHEN 'apple' THEN 'Apple' WHEN 'google' THEN 'Google'
             WHEN 'meta' THEN 'Meta' WHEN 'microsoft' THEN 'Microsoft' WHEN 'netflix' THEN 'Netflix' END,
        CASE WHEN url IS NULL OR url = '' THEN NULL
             WHEN lower(url) LIKE '%amazon.jobs%' THEN 'Amazon'
             WHEN lower(url) LIKE '%google.com%' THEN 'Google' END) AS employer FROM f),
flat AS (
  SELECT 'flat' AS feed, 6 AS companies,
         (SELECT count(*) FROM r WHERE employer IS NOT NULL AND url IS NULL)
         + (SELECT count(*) FROM (SELECT DISTINCT url, employer FROM r WHERE employer IS NOT NULL AND url IS NOT NULL)) AS jobs),
d AS (SELECT s_suppkey, s_nationkey % 3 + 1 AS np FROM supplier),
directory AS (
  SELECT 'directory' AS feed, count(*) AS companies, sum(CASE WHEN np = 1 THEN 1 ELSE 2 END) AS jobs FROM d)
SELECT feed, CAST(companies AS BIGINT) AS companies, CAST(jobs AS BIGINT) AS jobs FROM portfolio
UNION ALL SELECT feed, CAST(companies AS BIGINT), CAST(jobs AS BIGINT) FROM flat
UNION ALL SELECT feed, CAST(companies AS BIGINT), CAST(jobs AS BIGINT) FROM directory""")
def unified_state(spark, sf):
    """K6 over the whole tables: companies and jobs per feed in the unified warehouse (the
    jobs of a feed are counted through the companies' refreshed job counters)."""
    from . import jobs as K
    companies, jobs = _landed_portfolio(spark, sf)
    base, details, job_files = directory_inputs(spark, sf)
    fmt = K.format_directory(base, details, job_files, AS_OF)
    wh = K.unify(K.empty_warehouse(spark), (companies, jobs), _flat_feed(spark, sf), (fmt["companies"], fmt["jobs"]),
                 as_of=AS_OF)
    feed = (F.when(F.col("slug").startswith("cust-"), F.lit("portfolio"))
             .when(F.col("slug").startswith("sup-"), F.lit("directory")).otherwise(F.lit("flat")))
    return (wh["company"].groupBy(feed.alias("feed"))
              .agg(F.count(F.lit(1)).alias("companies"), F.sum("numJobs").cast("long").alias("jobs")))


_FLAT_SQL = f"""
WITH f AS (SELECT o_orderkey AS ord, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, o_orderstatus AS location,
                  {_IMPORT_URL_SQL} AS url, {_IMPORT_COMPANY_SQL} AS company FROM orders),
r AS (SELECT *, coalesce(
        CASE lower(company) WHEN 'amazon' THEN 'Amazon' WHEN 'apple' THEN 'Apple' WHEN 'google' THEN 'Google'
             WHEN 'meta' THEN 'Meta' WHEN 'microsoft' THEN 'Microsoft' WHEN 'netflix' THEN 'Netflix' END,
        CASE WHEN url IS NULL OR url = '' THEN NULL
             WHEN lower(url) LIKE '%amazon.jobs%' THEN 'Amazon'
             WHEN lower(url) LIKE '%google.com%' THEN 'Google' END) AS employer FROM f),
ok AS (SELECT * FROM r WHERE employer IS NOT NULL),
kept AS (SELECT * FROM ok WHERE url IS NULL
         UNION ALL SELECT * FROM ok WHERE url IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY url, employer ORDER BY ord) = 1),
held AS (SELECT DISTINCT url FROM f WHERE ord % 2 = 0 AND url LIKE '%amazon%')
"""


@query("flat_feed_state", _FLAT_SQL + """
SELECT employer, employer = 'Amazon' AS company_held, title, url, location AS office,
       'Order ' || id AS description FROM kept WHERE NOT (employer = 'Amazon' AND url IS NOT NULL AND url IN (SELECT url FROM held))
UNION ALL SELECT 'Amazon', TRUE, 'held', url, NULL, NULL FROM held""")
def flat_feed_state(spark, sf):
    """K5 twice over a warehouse that holds one of the employers and some of its jobs: held jobs stay,
    the second load adds nothing, offices are linked for the added jobs only."""
    from .. import schemas as SC
    from . import jobs as K
    flat = _flat_feed(spark, sf, F.col("o_orderstatus"))
    old = flat.filter((F.col("id").cast("long") % 2 == 0) & F.col("url").contains("amazon")).select("url").distinct()
    company = spark.range(1).select(F.lit("held").alias("id"), F.lit("Amazon").alias("name"), F.lit("amazon").alias("slug"))
    job = old.select(F.concat(F.lit("held-"), "url").alias("id"), F.lit("held").alias("title"), "url",
                     F.lit("held").alias("companyId"))
    wh = K.empty_warehouse(spark) | {"company": K.conform(company, SC.COMPANY), "job": K.conform(job, SC.JOB)}
    for _ in range(2):
        wh, _skipped = K.load_flat_feed(wh, flat, AS_OF)
    c = wh["company"].select(F.col("id").alias("companyId"), F.col("name").alias("employer"))
    off = wh["job_office"].join(wh["office"].select(F.col("id").alias("officeId"), F.col("location").alias("office")), "officeId")
    return (wh["job"].select(F.col("id").alias("jobId"), "companyId", "title", "url", "description").join(c, "companyId")
            .join(off, "jobId", "left")
            .select("employer", (F.col("companyId") == "held").alias("company_held"), "title", "url", "office", "description"))
