"""Merge / upsert queries.

Targets and batches are both read from the tables: the warehouse state is the customers
outside the BUILDING segment (companies) or the finished/open orders (jobs); the batch is
the BUILDING + MACHINERY customers or the open/pending orders, with changed values, so the
batch overlaps the target (updates), adds new keys (inserts) and leaves keys untouched.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import SEED_EMPLOYERS
from ..functions.text import surrogate_id
from ..operators import joins as J
from ..operators import merge as H
from ..sources.literals import empty_frame
from ..sources.readers import read_flat_jobs
from .catalog import query, table
from .bindings import _URL_SQL, _job_url

_COMPANY_T_SQL = """
t AS (SELECT 'cust-' || CAST(c_custkey AS VARCHAR) AS slug, c_custkey AS id, c_name AS name, c_mktsegment AS description,
             c_nationkey AS staffCount, CAST(0 AS BIGINT) AS numJobs FROM customer WHERE c_mktsegment <> 'BUILDING'),
s0 AS (SELECT CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN NULL ELSE 'cust-' || CAST(c_custkey AS VARCHAR) END AS slug,
              c_custkey + 1000000 AS id, lower(c_name) AS name, 'updated ' || c_mktsegment AS description,
              c_nationkey + 1 AS staffCount, CAST(99 AS BIGINT) AS numJobs, c_custkey AS ord
       FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
       UNION ALL
       SELECT 'cust-' || CAST(c_custkey AS VARCHAR), c_custkey + 2000000, 'stale', 'stale', 0, CAST(7 AS BIGINT),
              c_custkey - 1000000 FROM customer WHERE c_mktsegment = 'MACHINERY')"""


def _company_target(spark, sf):
    return table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING").select(
        F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("slug"), F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description"),
        F.col("c_nationkey").alias("staffCount"), F.lit(0).cast("long").alias("numJobs"))


def _company_batch(spark, sf):
    c = table(spark, sf, "customer")
    slug = F.concat(F.lit("cust-"), F.col("c_custkey").cast("string"))
    main = c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.when((F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "BUILDING"), F.lit(None).cast("string"))
         .otherwise(slug).alias("slug"),
        (F.col("c_custkey") + 1000000).alias("id"), F.lower("c_name").alias("name"),
        F.concat(F.lit("updated "), F.col("c_mktsegment")).alias("description"),
        (F.col("c_nationkey") + 1).alias("staffCount"), F.lit(99).cast("long").alias("numJobs"),
        F.col("c_custkey").alias("ord"))
    stale = c.filter(F.col("c_mktsegment") == "MACHINERY").select(
        slug.alias("slug"), (F.col("c_custkey") + 2000000).alias("id"), F.lit("stale").alias("name"),
        F.lit("stale").alias("description"), F.lit(0).alias("staffCount"), F.lit(7).cast("long").alias("numJobs"),
        (F.col("c_custkey") - 1000000).alias("ord"))
    return main.unionByName(stale)


@query("upsert_company", "WITH" + _COMPANY_T_SQL + """,
s AS (SELECT * FROM s0 WHERE slug IS NOT NULL QUALIFY row_number() OVER (PARTITION BY slug ORDER BY ord DESC) = 1
      UNION ALL SELECT * FROM s0 WHERE slug IS NULL)
SELECT coalesce(t.slug, s.slug) AS slug,
       CASE WHEN t.id IS NOT NULL THEN t.id ELSE s.id END AS id,
       CASE WHEN s.id IS NOT NULL THEN s.name ELSE t.name END AS name,
       CASE WHEN s.id IS NOT NULL THEN s.description ELSE t.description END AS description,
       CASE WHEN s.id IS NOT NULL THEN s.staffCount ELSE t.staffCount END AS staffCount,
       CASE WHEN t.id IS NOT NULL THEN t.numJobs ELSE s.numJobs END AS numJobs
FROM t FULL OUTER JOIN s ON t.slug = s.slug""")
def upsert_company(spark, sf):
    """H2 with missing slugs in the batch: these rows conflict with nothing and are inserted as they are."""
    batch = _company_batch(spark, sf)
    return H.upsert(_company_target(spark, sf), batch, "slug", ["name", "description", "staffCount"], ordinal="ord",
                    keep=["id", "numJobs"])


@query("insert_ignore", "WITH" + _COMPANY_T_SQL + """,
fresh AS (SELECT * FROM s0 WHERE slug IS NOT NULL AND slug NOT IN (SELECT slug FROM t)
          QUALIFY row_number() OVER (PARTITION BY slug ORDER BY ord) = 1)
SELECT slug, id, name, description, staffCount, numJobs FROM t
UNION ALL SELECT slug, id, name, description, staffCount, numJobs FROM fresh
UNION ALL SELECT slug, id, name, description, staffCount, numJobs FROM s0 WHERE slug IS NULL""")
def insert_ignore(spark, sf):
    return H.insert_ignore(_company_target(spark, sf), _company_batch(spark, sf), ["slug"], ["ord"])


_JOBS_SQL = f"""
e AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS companyId, o_orderpriority AS title, {_URL_SQL} AS url,
             o_totalprice AS salary FROM orders WHERE o_orderstatus IN ('F', 'O')),
s AS (SELECT o_custkey AS companyId, o_orderpriority AS title,
             CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE {_URL_SQL} END AS url,
             o_totalprice * 2 AS salary, o_orderkey AS ordinal FROM orders WHERE o_orderstatus IN ('O', 'P'))"""


def _jobs_target(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "O")).select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").alias("companyId"),
        F.col("o_orderpriority").alias("title"), _job_url().alias("url"), F.col("o_totalprice").alias("salary"))


def _jobs_batch(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("O", "P")).select(
        F.col("o_custkey").alias("companyId"), F.col("o_orderpriority").alias("title"),
        _job_url(F.col("o_orderpriority") != "5-LOW").alias("url"), (F.col("o_totalprice") * 2).alias("salary"),
        F.col("o_orderkey").alias("ordinal"))


_NEW_ID_SQL = "sha256(coalesce(CAST(companyId AS VARCHAR), '') || '::' || coalesce(url, '') || '::' || coalesce(title, ''))"


@query("upsert_jobs_title", "WITH" + _JOBS_SQL + f""",
s1 AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY companyId, title ORDER BY ordinal DESC) = 1)
SELECT e.id, e.companyId, e.title, CASE WHEN s1.ordinal IS NOT NULL THEN s1.url ELSE e.url END AS url,
       CASE WHEN s1.ordinal IS NOT NULL THEN s1.salary ELSE e.salary END AS salary
FROM e LEFT JOIN s1 ON e.companyId = s1.companyId AND e.title = s1.title
UNION ALL
SELECT {_NEW_ID_SQL}, companyId, title, url, salary FROM s1
WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.companyId = s1.companyId AND e.title = s1.title)""")
def upsert_jobs_title(spark, sf):
    return H.upsert_jobs(_jobs_target(spark, sf), _jobs_batch(spark, sf), mode="title")


@query("upsert_jobs_two_tier", "WITH" + _JOBS_SQL + f""",
c1 AS (SELECT * FROM s WHERE url IS NOT NULL AND url <> ''
       QUALIFY row_number() OVER (PARTITION BY companyId, url ORDER BY ordinal DESC) = 1
       UNION ALL SELECT * FROM s WHERE url IS NULL OR url = ''),
c2 AS (SELECT * FROM c1 QUALIFY row_number() OVER (PARTITION BY companyId, title ORDER BY ordinal DESC) = 1),
m AS (SELECT c2.*, coalesce(
        (SELECT min(e.id) FROM e WHERE e.companyId = c2.companyId AND e.url = c2.url AND c2.url <> ''),
        (SELECT min(e.id) FROM e WHERE e.companyId = c2.companyId AND e.title = c2.title)) AS mid FROM c2),
hits AS (SELECT * FROM m WHERE mid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY mid ORDER BY ordinal DESC) = 1)
SELECT e.id, e.companyId, CASE WHEN h.mid IS NOT NULL THEN h.title ELSE e.title END AS title,
       CASE WHEN h.mid IS NOT NULL THEN h.url ELSE e.url END AS url,
       CASE WHEN h.mid IS NOT NULL THEN h.salary ELSE e.salary END AS salary
FROM e LEFT JOIN hits h ON e.id = h.mid
UNION ALL
SELECT {_NEW_ID_SQL}, companyId, title, url, salary FROM m WHERE mid IS NULL""")
def upsert_jobs_two_tier(spark, sf):
    return H.upsert_jobs(_jobs_target(spark, sf), _jobs_batch(spark, sf), mode="two_tier")


@query("new_jobs", "WITH" + _JOBS_SQL + """
SELECT ordinal AS staged_id FROM s WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.companyId = s.companyId AND e.title = s.title)""")
def new_jobs(spark, sf):
    return J.new_jobs(_jobs_batch(spark, sf), _jobs_target(spark, sf), ["companyId", "title"]) \
        .select(F.col("ordinal").alias("staged_id"))


@query("match_existing", "WITH" + _JOBS_SQL + """
SELECT s.ordinal AS staged_id, min(e.id) AS existing_id FROM s JOIN e ON e.companyId = s.companyId AND e.title = s.title
GROUP BY s.ordinal""")
def match_existing(spark, sf):
    return J.match_existing(_jobs_batch(spark, sf), _jobs_target(spark, sf), ["companyId", "title"]) \
        .select(F.col("ordinal").alias("staged_id"), "existing_id")


@query("attach_company", """
SELECT o.o_orderkey, c.c_custkey AS companyId FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment <> 'BUILDING'""")
def attach_company(spark, sf):
    jobs = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    comp = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    return J.attach_company(jobs, comp, "o_custkey", "c_custkey", "c_custkey").select("o_orderkey", "companyId")


@query("upsert_salary", """
WITH s AS (SELECT l_orderkey AS jobId, nullif(l_discount, 0) * 1000 AS minValue, l_extendedprice AS maxValue,
                  'USD' AS currency, 'yearly' AS period FROM lineitem),
s1 AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY jobId
        ORDER BY minValue DESC NULLS FIRST, maxValue, currency, period) = 1),
t AS (SELECT o_orderkey AS jobId, o_totalprice / 100 AS minValue, o_totalprice AS maxValue, 'EUR' AS currency,
             'monthly' AS period FROM orders WHERE o_orderstatus = 'F')
SELECT coalesce(t.jobId, s1.jobId) AS jobId,
       CASE WHEN s1.jobId IS NOT NULL THEN s1.minValue ELSE t.minValue END AS minValue,
       CASE WHEN s1.jobId IS NOT NULL THEN s1.maxValue ELSE t.maxValue END AS maxValue,
       CASE WHEN s1.jobId IS NOT NULL THEN s1.currency ELSE t.currency END AS currency,
       CASE WHEN s1.jobId IS NOT NULL THEN s1.period ELSE t.period END AS period
FROM t FULL OUTER JOIN s1 ON t.jobId = s1.jobId""")
def upsert_salary(spark, sf):
    src = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("jobId"), (F.nullif(F.col("l_discount"), F.lit(0.0)) * 1000).alias("minValue"),
        F.col("l_extendedprice").alias("maxValue"), F.lit("USD").alias("currency"), F.lit("yearly").alias("period"))
    target = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("jobId"), (F.col("o_totalprice") / 100).alias("minValue"),
        F.col("o_totalprice").alias("maxValue"), F.lit("EUR").alias("currency"), F.lit("monthly").alias("period"))
    return H.upsert_salary(target, src)


@query("replace_links", """
SELECT DISTINCT jobId, officeId FROM (
  SELECT l_orderkey AS jobId, l_suppkey AS officeId FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
  UNION ALL
  SELECT o.o_orderkey, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'P')""")
def replace_links(spark, sf):
    bridge = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("jobId"), F.col("l_suppkey").alias("officeId"))
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P")
    touched = o.select(F.col("o_orderkey").alias("jobId"))
    c = table(spark, sf, "customer")
    new_links = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("jobId"), F.col("c_nationkey").cast("long").alias("officeId"))
    return H.replace_links(bridge, touched, new_links, "jobId")


@query("bridge_dedupe_report", """
SELECT count(*) AS total, count(DISTINCT (l_orderkey, l_suppkey)) AS "unique",
       count(*) - count(DISTINCT (l_orderkey, l_suppkey)) AS removed FROM lineitem""")
def bridge_dedupe_report(spark, sf):
    return H.bridge_dedupe_report(table(spark, sf, "lineitem"), "l_orderkey", "l_suppkey")


_SEEDS_VALUES = ", ".join(f"('{n}')" for n in SEED_EMPLOYERS)


def _supplier_companies(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
        F.lower("s_name").alias("slug"), F.lit(None).cast("string").alias("description"))


@query("seed_companies", f"""
WITH t AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, lower(s_name) AS slug, NULL AS description FROM supplier),
seeds(name) AS (VALUES {_SEEDS_VALUES})
SELECT id, name, slug, description FROM t
UNION ALL
SELECT sha256(lower(name)), name, lower(name), name || ' job listings' FROM seeds WHERE name NOT IN (SELECT name FROM t)""")
def seed_companies(spark, sf):
    return H.ensure_seed_companies(_supplier_companies(spark, sf), SEED_EMPLOYERS)


_IMPORT_URL_SQL = """CASE WHEN o_orderstatus = 'F' THEN 'https://www.amazon.jobs/en/jobs/' || CAST(o_custkey AS VARCHAR)
 WHEN o_orderstatus = 'O' THEN 'https://careers.google.com/jobs/' || CAST(o_custkey AS VARCHAR)
 WHEN o_orderpriority = '3-MEDIUM' THEN 'https://example.org/jobs/' || CAST(o_custkey AS VARCHAR) ELSE NULL END"""
_IMPORT_COMPANY_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'amazon' WHEN '2-HIGH' THEN 'Google LLC'
 WHEN '3-MEDIUM' THEN '' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'NETFLIX' END"""
AS_OF = "2024-03-31 12:00:00"


@query("import_flat", f"""
WITH f AS (SELECT o_orderkey AS ord, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title,
                  'Order ' || CAST(o_orderkey AS VARCHAR) AS "desc", o_orderdate AS date,
                  {_IMPORT_URL_SQL} AS url, {_IMPORT_COMPANY_SQL} AS company FROM orders),
r AS (SELECT *, coalesce(
        CASE lower(company) WHEN 'amazon' THEN 'Amazon' WHEN 'apple' THEN 'Apple' WHEN 'google' THEN 'Google'
             WHEN 'meta' THEN 'Meta' WHEN 'microsoft' THEN 'Microsoft' WHEN 'netflix' THEN 'Netflix' END,
        CASE WHEN url IS NULL OR url = '' THEN NULL
             WHEN lower(url) LIKE '%amazon.jobs%' THEN 'Amazon'
             WHEN lower(url) LIKE '%google.com%' THEN 'Google' END) AS employer FROM f),
j AS (SELECT ord, id, title, url, sha256(lower(employer)) AS companyId,
             strftime(coalesce(date, TIMESTAMP '{AS_OF}'), '%Y-%m-%d %H:%M:%S') AS timeStamp,
             '{{"description":"' || "desc" || '"}}' AS skills FROM r WHERE employer IS NOT NULL)
SELECT id, title, url, companyId, timeStamp, skills FROM j WHERE url IS NULL
UNION ALL
SELECT id, title, url, companyId, timeStamp, skills FROM j WHERE url IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY url, companyId ORDER BY ord) = 1""")
def import_flat(spark, sf):
    """Normalise (A4) → resolve employer (I14) → seed employers (H7) → insert-ignore on
    (url, company) (H1) into the jobs table."""
    o = table(spark, sf, "orders")
    flat = o.select(F.col("o_orderkey").alias("ord"), F.col("o_orderkey").cast("string").alias("id"),
                    F.col("o_orderpriority").alias("title"),
                    F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("desc"),
                    F.col("o_orderdate").cast("string").alias("date"), F.lit(None).cast("string").alias("location"),
                    F.expr(_IMPORT_URL_SQL.replace("VARCHAR", "STRING")).alias("url"),
                    F.expr(_IMPORT_COMPANY_SQL).alias("company"))
    norm = read_flat_jobs(flat)
    resolved = J.resolve_employer(norm, "company", "url").filter(F.col("employer").isNotNull())
    companies = H.ensure_seed_companies(_supplier_companies(spark, sf), SEED_EMPLOYERS)
    with_company = J.lookup(resolved, companies, "employer", "name", "id", "companyId")
    jobs = with_company.select(
        "ord", "id", "title", "url", "companyId",
        F.date_format(F.coalesce(F.col("date"), F.to_timestamp(F.lit(AS_OF))), "yyyy-MM-dd HH:mm:ss").alias("timeStamp"),
        F.to_json(F.struct(F.col("desc").alias("description"))).alias("skills"))
    empty = empty_frame(spark, T.StructType([T.StructField(c, jobs.schema[c].dataType) for c in jobs.columns]))
    return H.insert_ignore(empty, jobs, ["url", "companyId"], ["ord"]).drop("ord")


_INVESTOR_SQL = """
t AS (SELECT 'inv-' || CAST(c_custkey AS VARCHAR) AS slug, c_name AS name, CAST(c_custkey AS VARCHAR) AS id
      FROM customer WHERE c_mktsegment <> 'BUILDING'),
s0 AS (SELECT 'inv-' || CAST(c_custkey AS VARCHAR) AS slug,
              CASE WHEN c_acctbal < 0 THEN 'Customer#' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0')
                   ELSE 'renamed ' || c_name END AS name,
              'new-' || CAST(c_custkey AS VARCHAR) AS id, c_custkey AS ord
       FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
s AS (SELECT * FROM s0 QUALIFY row_number() OVER (PARTITION BY slug ORDER BY ord DESC) = 1),
clash AS (SELECT s.* FROM s WHERE EXISTS (SELECT 1 FROM t WHERE t.name = s.name AND t.slug <> s.slug)),
ok AS (SELECT * FROM s WHERE slug NOT IN (SELECT slug FROM clash))"""


def _investor_frames(spark, sf):
    c = table(spark, sf, "customer")
    slug = F.concat(F.lit("inv-"), F.col("c_custkey").cast("string"))
    target = c.filter(F.col("c_mktsegment") != "BUILDING").select(
        slug.alias("slug"), F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("id"))
    batch = c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        slug.alias("slug"),
        F.when(F.col("c_acctbal") < 0,
               F.concat(F.lit("Customer#"), F.lpad((F.col("c_custkey") + 1).cast("string"), 9, "0")))
         .otherwise(F.concat(F.lit("renamed "), F.col("c_name"))).alias("name"),
        F.concat(F.lit("new-"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_custkey").alias("ord"))
    return target, batch


@query("upsert_investor", "WITH" + _INVESTOR_SQL + """
SELECT coalesce(t.slug, ok.slug) AS slug, CASE WHEN ok.slug IS NOT NULL THEN ok.name ELSE t.name END AS name,
       CASE WHEN t.slug IS NOT NULL THEN t.id ELSE ok.id END AS id
FROM t FULL OUTER JOIN ok ON t.slug = ok.slug""")
def upsert_investor(spark, sf):
    """H3: investors by slug, name replaced; a batch name already owned by another slug is
    rejected (unique name) instead of failing the load."""
    target, batch = _investor_frames(spark, sf)
    state, _rejects = H.upsert_dimension_checked(target, batch, "slug", "name", "ord", ["name"])
    return state.select("slug", "name", "id")


@query("upsert_investor_rejects", "WITH" + _INVESTOR_SQL + " SELECT slug, name FROM clash")
def upsert_investor_rejects(spark, sf):
    target, batch = _investor_frames(spark, sf)
    return H.upsert_dimension_checked(target, batch, "slug", "name", "ord", ["name"])[1].select("slug", "name")


def _landed_portfolio(spark, sf):
    """customers / orders in the landed portfolio shapes (one 'file' each, ordinal = key + 1)."""
    from .. import schemas as SC
    c = table(spark, sf, "customer")
    k = F.col("c_custkey").cast("string")
    companies = c.select(
        F.lit("customers.json").alias("file_name"), (F.col("c_custkey") + 1).cast("int").alias("pos"),
        F.col("c_name").alias("name"), F.concat(F.lit("cust-"), k).alias("slug"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("c"), k, F.lit(".example.com"))).alias("domain"),
        F.col("c_nationkey").alias("staffCount"),
        F.array(F.col("c_mktsegment"), F.lit("")).alias("markets"),
        F.array(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))).alias("officeLocations"),
        F.lit("TPC").alias("dataSource"))
    companies = companies.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SC.PORTFOLIO_COMPANY.fields if f.name not in companies.columns])
    o = table(spark, sf, "orders")
    jobs = o.select(
        F.lit("orders.json").alias("file_name"), (F.col("o_orderkey") + 1).cast("int").alias("pos"),
        F.col("o_orderpriority").alias("title"), F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("companySlug"),
        F.concat(F.lit("job/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.array(F.col("o_orderstatus")).alias("locations"),
        F.struct(F.col("o_totalprice").cast("string").alias("minValue"), F.lit(None).cast("string").alias("maxValue"),
                 F.lit("USD").alias("currency"), F.lit("yearly").alias("period")).alias("salary"))
    jobs = jobs.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SC.PORTFOLIO_JOB.fields if f.name not in jobs.columns])
    return companies, jobs


def _portfolio_state(spark, sf):
    from . import jobs as K
    companies, jobs = _landed_portfolio(spark, sf)
    wh, _ = K.load_portfolio(K.empty_warehouse(spark), companies, jobs, mode="upsert")
    return wh


@query("portfolio_company_state", """
WITH j AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY o_custkey)
SELECT 'cust-' || CAST(c_custkey AS VARCHAR) AS slug, nullif(c_nationkey, 0) AS staffCount,
       CAST(coalesce(j.n, 0) AS BIGINT) AS numJobs,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN 'c' || CAST(c_custkey AS VARCHAR) || '.example.com' END AS domain,
       c_mktsegment AS market, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS office
FROM customer LEFT JOIN j ON j.o_custkey = c_custkey""")
def portfolio_company_state(spark, sf):
    """K2 (staging → company upsert → dimensions / bridges → jobs → counts) over the whole
    customer / orders tables: the company table with its market and office links."""
    wh = _portfolio_state(spark, sf)
    c = wh["company"].select("id", "slug", "staffCount", "numJobs", "domain")
    m = wh["company_market"].join(wh["market"].select(F.col("id").alias("marketId"), F.col("name").alias("market")),
                                  "marketId").select(F.col("companyId").alias("id"), "market")
    off = wh["company_office"].join(wh["office"].select(F.col("id").alias("officeId"), F.col("location").alias("office")),
                                    "officeId").select(F.col("companyId").alias("id"), "office")
    return c.join(m, "id", "left").join(off, "id", "left").drop("id")


@query("portfolio_job_state", """
WITH last AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) = 1)
SELECT 'cust-' || CAST(o_custkey AS VARCHAR) AS slug, o_orderpriority AS title, 'job/' || CAST(o_orderkey AS VARCHAR) AS url,
       o_totalprice AS minValue, o_orderstatus AS office FROM last""")
def portfolio_job_state(spark, sf):
    """K2 jobs: one job per (company, title), the last staged row wins; its salary range and
    office link attach through the staging ordinal."""
    wh = _portfolio_state(spark, sf)
    c = wh["company"].select(F.col("id").alias("companyId"), "slug")
    j = wh["job"].select(F.col("id").alias("jobId"), "companyId", "title", "url")
    sal = wh["salary_range"].select("jobId", "minValue")
    off = wh["job_office"].join(wh["office"].select(F.col("id").alias("officeId"), F.col("location").alias("office")),
                                "officeId").select("jobId", "office")
    return j.join(c, "companyId").join(sal, "jobId", "left").join(off, "jobId", "left") \
        .select("slug", "title", "url", "minValue", "office")


# A warehouse that earlier loads filled: the customers outside BUILDING as companies, and per fulfilled
# order of theirs a job that another feed described.
_HELD_SQL = """
WITH company AS (SELECT c_custkey, c_mktsegment <> 'BUILDING' AS held FROM customer),
held AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey
         WHERE o_orderstatus = 'F' AND c_mktsegment <> 'BUILDING')
"""


def _held_warehouse(spark, sf, title):
    from .. import schemas as SC
    from . import jobs as K
    c = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    key = F.col("c_custkey").cast("string")
    company = c.select(F.concat(F.lit("held-"), key).alias("id"), F.col("c_name").alias("name"),
                       F.concat(F.lit("cust-"), key).alias("slug"), F.lit("W1").alias("batchInfo"),
                       F.lit(-1).alias("staffCount"), F.lit(0).alias("numJobs"))
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").join(
        c.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")
    k = F.col("o_orderkey").cast("string")
    job = o.select(F.concat(F.lit("held-"), k).alias("id"), title.alias("title"), F.concat(F.lit("job/"), k).alias("url"),
                   F.concat(F.lit("held-"), F.col("o_custkey").cast("string")).alias("companyId"),
                   F.concat(F.lit("text "), k).alias("description"), F.lit("1%").alias("equityRange"))
    salary = job.select(F.concat(F.lit("s-"), "id").alias("id"), F.col("id").alias("jobId"), F.lit(1.0).alias("minValue"))
    return K.empty_warehouse(spark) | {"company": K.conform(company, SC.COMPANY), "job": K.conform(job, SC.JOB),
                                       "salary_range": K.conform(salary, SC.SALARY_RANGE)}


def _state_rows(wh):
    """Every job with its company's slug, its salary range and its office."""
    c = wh["company"].select(F.col("id").alias("companyId"), "slug", "batchInfo", "staffCount", "numJobs")
    sal = wh["salary_range"].select("jobId", "minValue")
    off = wh["job_office"].join(wh["office"].select(F.col("id").alias("officeId"), F.col("location").alias("office")),
                                "officeId").select("jobId", "office")
    j = wh["job"].select(F.col("id").alias("jobId"), "companyId", "title", "url", "description", "equityRange")
    return j.join(c, "companyId").join(sal, "jobId", "left").join(off, "jobId", "left").select(
        "slug", "batchInfo", "staffCount", "numJobs", "title", "url", "description", "equityRange", "minValue", "office")


@query("portfolio_upsert_state", _HELD_SQL + """,
last AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) = 1),
job AS (SELECT l.*, h.o_orderkey AS old FROM last l
        LEFT JOIN held h ON h.o_custkey = l.o_custkey AND h.o_orderpriority = l.o_orderpriority)
SELECT 'cust-' || CAST(c.c_custkey AS VARCHAR) AS slug, CASE WHEN company.held THEN 'W1' END AS batchInfo,
       nullif(c.c_nationkey, 0) AS staffCount, count(*) OVER (PARTITION BY c.c_custkey) AS numJobs,
       o_orderpriority AS title, 'job/' || CAST(o_orderkey AS VARCHAR) AS url,
       'text ' || CAST(old AS VARCHAR) AS description, CASE WHEN old IS NOT NULL THEN '1%' END AS equityRange,
       o_totalprice AS minValue, o_orderstatus AS office
FROM job JOIN customer c ON o_custkey = c.c_custkey JOIN company ON company.c_custkey = c.c_custkey""")
def portfolio_upsert_state(spark, sf):
    """K2, upsert, into a warehouse with rows: every held job of a staged (company, title) takes the last
    staged row's columns, keeps what other feeds wrote, and has its salary range and offices replaced."""
    from . import jobs as K
    wh, _ = K.load_portfolio(_held_warehouse(spark, sf, F.col("o_orderpriority")), *_landed_portfolio(spark, sf))
    return _state_rows(wh)


@query("portfolio_insert_state", _HELD_SQL + """
SELECT 'cust-' || CAST(c.c_custkey AS VARCHAR) AS slug, CASE WHEN company.held THEN 'W1' END AS batchInfo,
       CASE WHEN company.held THEN -1 ELSE nullif(c.c_nationkey, 0) END AS staffCount,
       count(*) OVER (PARTITION BY c.c_custkey) AS numJobs,
       CASE WHEN h.o_orderkey IS NOT NULL THEN 'old ' ELSE '' END || o.o_orderpriority AS title,
       'job/' || CAST(o.o_orderkey AS VARCHAR) AS url, 'text ' || CAST(h.o_orderkey AS VARCHAR) AS description,
       CASE WHEN h.o_orderkey IS NOT NULL THEN '1%' END AS equityRange, o_totalprice AS minValue, o_orderstatus AS office
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN company ON company.c_custkey = c.c_custkey
LEFT JOIN held h ON h.o_orderkey = o.o_orderkey""")
def portfolio_insert_state(spark, sf):
    """K2, insert, into a warehouse with rows: held companies and held (url, company) jobs stay as they
    are, the others are added; salary ranges and offices follow the staged rows."""
    from . import jobs as K
    held = _held_warehouse(spark, sf, F.concat(F.lit("old "), "o_orderpriority"))
    wh, _ = K.load_portfolio(held, *_landed_portfolio(spark, sf), mode="insert")
    return _state_rows(wh)
