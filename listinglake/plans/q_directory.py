"""The directory feed (K3 format → K4 load) over the whole supplier table.

Suppliers play the directory companies: a base record per supplier, a details record for the
suppliers of nations 0–19 (founders, an overriding website and team size), and a jobs page
per supplier whose postings are generated row-locally (1–3 per supplier, so a document stays
bounded) — nothing is collected beyond one company's own links, and nothing is fixed input.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as SC
from .catalog import query, table

AS_OF = "2024-03-31 00:00:00"


def _fill(df, schema):
    for f in schema.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*schema.names)


def directory_inputs(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey").cast("string")
    n = F.col("s_nationkey")
    slug = F.concat(F.lit("sup-"), k)
    base = _fill(s.select(
        slug.alias("slug"), F.col("s_name").alias("name"), F.concat(F.lit("W"), (n % 10).cast("string")).alias("batch"),
        F.concat(F.lit("https://www.s"), k, F.lit(".example.com")).alias("website"), n.alias("team_size"),
        F.concat(F.lit("NATION_"), n.cast("string"), F.lit(", Remote")).alias("all_locations"),
        F.when(F.col("s_acctbal") < 0, F.lit("Inactive")).otherwise(F.lit("Active")).alias("status"),
        F.when(n < 12, F.lit("Seed")).alias("stage"), (F.col("s_suppkey") * 1000).alias("launched_at"),
        (F.col("s_acctbal") > 5000).alias("top_company"),
        F.array(F.when(n < 12, F.lit("Fintech")).otherwise(F.lit("AI"))).alias("industries"),
        F.array(F.lit(""), F.lit("B2B")).alias("tags"),
        F.when(n < 5, F.array(F.lit("Remote"))).alias("regions")), SC.DIRECTORY_BASE)
    founder = F.struct(F.concat(F.lit("F"), k).alias("name"), F.lit("CEO").alias("title"), F.lit("bio").alias("bio"),
                       F.create_map(F.lit("linkedin"), F.concat(F.lit("in/f"), k)).alias("social_links"))
    details = _fill(s.filter(n < 20).select(
        slug.alias("slug"), F.concat(F.lit("https://s"), k, F.lit(".example.io")).alias("website"),
        (n + 1).alias("teamSize"), F.lit("").alias("status"),
        F.when(n < 3, F.array(founder, founder)).otherwise(F.array(founder)).alias("founders"),
        F.create_map(F.lit("linkedin"), F.concat(F.lit("in/c"), k)).alias("social_links")), SC.DIRECTORY_DETAILS)

    def posting(i):
        return F.struct(
            F.when(i == 2, F.lit("Engineering Manager")).otherwise(F.lit("Senior Engineer")).alias("title"),
            F.concat(F.lit("/companies/sup-"), k, F.lit("/jobs/"), i.cast("string")).alias("url"),
            F.lit(None).cast("string").alias("applyUrl"), F.lit(None).cast("string").alias("companyUrl"),
            F.when(i == 2, F.lit("Contract")).otherwise(F.lit("Full Time")).alias("type"),
            F.lit("Engineering").alias("role"), F.lit(None).cast("string").alias("roleSpecificType"),
            F.when(n < 5, F.lit("Remote")).otherwise(F.concat(F.lit("NATION_"), n.cast("string"))).alias("location"),
            F.concat(i.cast("string"), F.lit(" months ago")).alias("createdAt"),
            F.concat(i.cast("string"), F.lit("+ years")).alias("minExperience"),
            F.when(i == 1, F.concat(F.lit("$"), (F.lit(100) + n).cast("string"), F.lit("K - $150K")))
             .otherwise(F.lit("")).alias("salaryRange"),
            F.lit(None).cast("string").alias("equityRange"))
    jobs = _fill(s.select(slug.alias("slug"), F.lit("Active").alias("status"),
                          F.transform(F.sequence(F.lit(1), (n % 3 + 1).cast("int")), posting).alias("jobPostings")),
                 SC.DIRECTORY_JOBS)
    return base, details, jobs


def _directory_state(spark, sf):
    from . import jobs as K
    base, details, jobs = directory_inputs(spark, sf)
    fmt = K.format_directory(base, details, jobs, AS_OF)
    wh, _ = K.load_directory(K.empty_warehouse(spark), fmt["companies"], fmt["jobs"])
    return wh


_DIR_SQL = """
WITH s AS (SELECT *, 'sup-' || CAST(s_suppkey AS VARCHAR) AS slug, s_nationkey % 3 + 1 AS np FROM supplier),
p AS (SELECT slug, s_nationkey, unnest(range(1, np + 1)) AS i FROM s),
pj AS (SELECT slug, s_nationkey, i, CASE WHEN i = 2 THEN 'Engineering Manager' ELSE 'Senior Engineer' END AS title FROM p),
kept AS (SELECT * FROM pj QUALIFY row_number() OVER (PARTITION BY slug, title ORDER BY i DESC) = 1)
"""


@query("directory_company_state", _DIR_SQL + """
SELECT s.slug,
       CASE WHEN s.s_nationkey < 20 THEN 's' || CAST(s.s_suppkey AS VARCHAR) || '.example.io'
            ELSE 's' || CAST(s.s_suppkey AS VARCHAR) || '.example.com' END AS domain,
       CASE WHEN s.s_nationkey <> 0 THEN s.s_nationkey WHEN s.s_nationkey < 20 THEN s.s_nationkey + 1 ELSE 0 END AS staffCount,
       (SELECT count(*) FROM kept WHERE kept.slug = s.slug) AS numJobs,
       s.s_acctbal > 5000 AS isFeatured, s.s_nationkey < 5 AS isRemoteFriendly,
       CASE WHEN s.s_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS status,
       CASE WHEN s.s_nationkey < 20 THEN 1 ELSE 0 END AS founders,
       CASE WHEN s.s_nationkey < 12 THEN 'B2B,Fintech' ELSE 'AI,B2B' END AS markets
FROM s""")
def directory_company_state(spark, sf):
    """K3 + K4 over the supplier table: the loaded company rows with founder and market links."""
    wh = _directory_state(spark, sf)
    c = wh["company"].select("id", "slug", "domain", "staffCount", "numJobs", "isFeatured", "isRemoteFriendly", "status")
    f = wh["company_founder"].groupBy(F.col("companyId").alias("id")).agg(F.count(F.lit(1)).alias("founders"))
    m = (wh["company_market"].join(wh["market"].select(F.col("id").alias("marketId"), "name"), "marketId")
         .groupBy(F.col("companyId").alias("id")).agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("markets")))
    return (c.join(f, "id", "left").join(m, "id", "left")
             .select("slug", "domain", "staffCount", "numJobs", "isFeatured", "isRemoteFriendly", "status",
                     F.coalesce(F.col("founders"), F.lit(0)).alias("founders"), "markets"))


@query("directory_job_state", _DIR_SQL + """
SELECT k.slug, k.title, 'https://www.ycombinator.com/companies/' || k.slug || '/jobs/' || CAST(k.i AS VARCHAR) AS url,
       k.s_nationkey < 5 AS remote, k.title LIKE '%Manager%' AS manager, k.i = 2 AS contractor,
       CAST(k.i AS INTEGER) AS minYearsExp,
       CASE WHEN k.i = 1 THEN CAST((100 + k.s_nationkey) * 1000 AS DOUBLE) END AS minValue,
       CASE WHEN k.title LIKE 'Senior%' THEN 'SENIOR' ELSE 'MID' END AS seniority
FROM kept k""")
def directory_job_state(spark, sf):
    """K3 + K4 jobs: postings collapsed per (company, title) (last posting wins), parsed
    flags / experience / seniority, and the salary range of the surviving posting."""
    wh = _directory_state(spark, sf)
    c = wh["company"].select(F.col("id").alias("companyId"), "slug")
    j = wh["job"].select(F.col("id").alias("jobId"), "companyId", "title", "url", "remote", "manager", "contractor",
                         "minYearsExp", "jobSeniorities")
    sal = wh["salary_range"].select("jobId", "minValue")
    seniority = F.map_keys(F.from_json("jobSeniorities", "map<string,boolean>"))[0]
    return (j.join(c, "companyId").join(sal, "jobId", "left")
             .select("slug", "title", "url", "remote", "manager", "contractor", "minYearsExp", "minValue",
                     seniority.alias("seniority")))


@query("directory_job_offices", _DIR_SQL + """
SELECT DISTINCT slug, title, CASE WHEN s_nationkey < 5 THEN 'Remote' ELSE 'NATION_' || CAST(s_nationkey AS VARCHAR) END AS office
FROM pj""")
def directory_job_offices(spark, sf):
    """K4 office links: the locations of all postings at the jobs they ended in."""
    wh = _directory_state(spark, sf)
    j = wh["job"].select(F.col("id").alias("jobId"), "companyId", "title")
    return (wh["job_office"].join(wh["office"].select(F.col("id").alias("officeId"), F.col("location").alias("office")), "officeId")
            .join(j, "jobId").join(wh["company"].select(F.col("id").alias("companyId"), "slug"), "companyId")
            .select("slug", "title", "office"))


# Declared job-source order of the consolidation query (one folder per order priority digit,
# deliberately not alphabetical) and one registered folder that does not exist.
_JOB_REGISTRY = [("p2", "folder=p2", "HIGH"), ("p1", "folder=p1", "URGENT"), ("p9", "folder=p9", "MISSING"),
                 ("p3", "folder=p3", None), ("p5", "folder=p5", "LOW"), ("p4", "folder=p4", None)]


def _landed_job_tree(spark, sf, root):
    """orders landed as per-source job files of ≤ 1000 records (keys are unique): even file
    keys as bare arrays, odd ones as ``{"jobs": [...]}`` — one write job."""
    from ..sources.sinks import write_json_wrapped
    o = table(spark, sf, "orders")
    rec = o.select(
        F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)).alias("folder"),
        F.floor(F.col("o_orderkey") / 1000).alias("file_key"), F.col("o_orderkey"),
        F.col("o_orderstatus").alias("title"), F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("companySlug"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit(".com")).alias("companyDomain"),
        F.concat(F.lit("job/"), F.col("o_orderkey").cast("string")).alias("url"))
    write_json_wrapped(rec, root, "file_key", wrapper="jobs", order=["o_orderkey"], folders=["folder"],
                       wrap_when=F.col("file_key") % 2 == 1)


@query("portfolio_consolidated_jobs", """
WITH j AS (SELECT o_orderkey, 'p' || substr(o_orderpriority, 1, 1) AS folder, o_orderstatus AS title,
                  'C' || CAST(o_custkey AS VARCHAR) || '.com' AS companyDomain, 'job/' || CAST(o_orderkey AS VARCHAR) AS url,
                  'file_key=' || CAST(o_orderkey // 1000 AS VARCHAR) AS f
           FROM orders),
r AS (SELECT *, CASE folder WHEN 'p2' THEN 0 WHEN 'p1' THEN 1 WHEN 'p3' THEN 3 WHEN 'p5' THEN 4 WHEN 'p4' THEN 5 END AS source_rank
      FROM j)
SELECT companyDomain, title, 'folder=' || folder AS sourceFolder, url FROM r
QUALIFY row_number() OVER (PARTITION BY lower(companyDomain || '_' || title) ORDER BY source_rank, f, o_orderkey) = 1""")
def portfolio_consolidated_jobs(spark, sf):
    """K1 over the whole orders table landed as per-source job files: declared source order,
    then file path, then position in the file; the first row per lower(domain_title) wins."""
    from ..session import scratch_path
    from . import jobs as K
    root = scratch_path(spark, "landed-jobs")
    _landed_job_tree(spark, sf, root)
    out = K.consolidate_portfolio(spark, root, [], _JOB_REGISTRY, file_order="file_path", glob="*.txt", recursive=True)
    return out["jobs"].select("companyDomain", "title", "sourceFolder", "url")


@query("portfolio_consolidated_summary", """
WITH j AS (SELECT lower('C' || CAST(o_custkey AS VARCHAR) || '.com' || '_' || o_orderstatus) AS k FROM orders)
SELECT count(*) AS processed, count(DISTINCT k) AS "unique", count(*) - count(DISTINCT k) AS duplicates FROM j""")
def portfolio_consolidated_summary(spark, sf):
    """K1 dedupe summary (D5) over the landed job tree."""
    from ..session import scratch_path
    from . import jobs as K
    root = scratch_path(spark, "landed-jobs")
    _landed_job_tree(spark, sf, root)
    return K.consolidate_portfolio(spark, root, [], _JOB_REGISTRY, file_order="file_path", glob="*.txt",
                                   recursive=True)["job_summary"]
