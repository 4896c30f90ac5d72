"""Landed files of several sources with a document per line (A1, A3, A6, K1, K2): written as a bounded number of files, equally
named in every source folder, read back split over tasks, consolidated and loaded."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import short_id
from ..session import scratch_path
from ..sources import readers as R
from ..sources import sinks as S
from . import jobs as K
from .catalog import query, table

ORDER_RECORD = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                             T.StructField("o_totalprice", T.DoubleType())])


@query("json_documents", """
SELECT o_orderkey, o_custkey, o_totalprice, 'status=' || o_orderstatus AS folder,
       CAST(row_number() OVER (PARTITION BY o_orderstatus, o_orderkey // 500 ORDER BY o_orderkey) AS INTEGER) AS pos FROM orders""")
def json_documents(spark, sf):
    """A6 + A1: the whole orders table as documents of up to 500 orders, many to a file (bare arrays and wrapper objects
    mixed), and back."""
    path = scratch_path(spark, "documents")
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), F.floor(F.col("o_orderkey") / 500).alias("doc"),
                                          "o_orderkey", "o_custkey", "o_totalprice")
    S.write_json_documents(o, path, "doc", wrapper="orders", order=["o_orderkey"], folders=["status"], wrap_when=F.col("file_key") % 2 == 1)
    rows, _errors = R.read_json_lines(spark, path, "orders", ORDER_RECORD, glob="*.txt", recursive=True)
    folder = F.element_at(F.split(F.col("file_path"), "/"), -2)
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", folder.alias("folder"), "pos")


@query("json_lines_rejects", """
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'unreadable JSON' WHEN o_orderkey % 17 = 0 THEN 'record is no JSON object' END AS reason,
       CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 THEN o_totalprice END AS o_totalprice, TRUE AS in_order FROM orders""")
def json_lines_rejects(spark, sf):
    """A1 over JSON Lines with broken records: these become reject rows with their text, all others are read, and line
    numbers follow the lines of each file."""
    path = scratch_path(spark, "lines")
    body = (F.when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey").cast("string"), F.lit(', "o_cust')))
             .when(F.col("o_orderkey") % 17 == 0, F.format_string('["o_orderkey %s"]', F.col("o_orderkey").cast("string")))
             .otherwise(F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice"))))
    (table(spark, sf, "orders").repartitionByRange(3, "o_orderkey").sortWithinPartitions("o_orderkey")
     .select(body.alias("value")).write.text(path))
    rows, errors = R.read_json_lines(spark, path, "orders", ORDER_RECORD, glob="*.txt")
    key = F.regexp_extract("raw", "o_orderkey\"?[: ]+([0-9]+)", 1)
    bad = errors.filter(key != "").select(key.cast("long").alias("o_orderkey"), "reason", F.lit(None).cast("double").alias("o_totalprice"), "file_path", "line")
    both = rows.select("o_orderkey", F.lit(None).cast("string").alias("reason"), "o_totalprice", "file_path", "line").unionByName(bad)
    # every file holds consecutive keys of the table, so a line's number is the key's place among the file's keys
    places = both.groupBy("file_path").agg(F.array_sort(F.collect_list("o_orderkey")).alias("keys")).select(
        "file_path", F.posexplode("keys").alias("at", "o_orderkey"))
    return (both.join(places, ["file_path", "o_orderkey"])
            .select("o_orderkey", "reason", "o_totalprice", (F.col("line") == F.col("at") + 1).alias("in_order")))


# -------------------------------------------------------------- two sources with equally named files
_JOB_SOURCES = [("south", "folder=s", "SOUTH"), ("none", "folder=none", "NONE"), ("north", "folder=n", None)]
_COMPANY_SOURCES = [("y", "folder=y", "Y BOARD"), ("x", "folder=x", None)]


def _land(spark, sf):
    """customers and orders as documents per line, dealt over two company and two job folders by one write each: a task
    writes the same file name into every folder. Returns the root."""
    root = scratch_path(spark, "boards")
    k = F.col("o_custkey").cast("string")
    jobs = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("s")).otherwise(F.lit("n")).alias("folder"), F.floor(F.col("o_custkey") / 20).alias("doc"),
        "o_orderkey", F.concat(F.col("o_orderpriority"), F.lit("/"), (F.col("o_orderkey") % 7).cast("string")).alias("title"),
        F.concat(F.lit("cust-"), k).alias("companySlug"), F.concat(F.lit("c"), k, F.lit(".com")).alias("companyDomain"),
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("job/"), k, F.lit("/"), F.year("o_orderdate").cast("string"))).alias("url"),
        F.array("o_orderstatus").alias("locations"), F.struct(F.col("o_totalprice").cast("string").alias("minValue")).alias("salary"))
    S.write_json_documents(jobs, f"{root}/jobs", "doc", wrapper="jobs", order=["o_orderkey"], folders=["folder"], wrap_when=F.col("file_key") % 2 == 1)
    c = table(spark, sf, "customer")
    k = F.col("c_custkey").cast("string")
    boards = F.array_compact(F.array(F.when(F.col("c_nationkey") >= 10, F.lit("y")), F.when(F.col("c_nationkey") < 15, F.lit("x"))))
    companies = c.select(F.explode(boards).alias("folder"), F.floor(F.col("c_custkey") / 50).alias("doc"), "c_custkey", "c_name", "c_mktsegment").select(
        "folder", "doc", "c_custkey", F.concat(F.col("folder"), F.lit(" "), "c_name").alias("name"), F.concat(F.lit("cust-"), k).alias("slug"),
        F.when(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.concat(F.lit("c"), k, F.lit(".com"))).alias("domain"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("alt"), k)).alias("companyDomain"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_custkey") % 5).alias("numJobs"))
    S.write_json_documents(companies, f"{root}/companies", "doc", order=["c_custkey"], folders=["folder"])
    return root


def _consolidated(spark, sf):
    root = _land(spark, sf)
    companies = [(k, f"companies/{f}", d) for k, f, d in _COMPANY_SOURCES]
    return K.consolidate_portfolio(spark, root, companies, [(k, f"jobs/{f}", d) for k, f, d in _JOB_SOURCES], file_order="file_path",
                                   glob="*.txt", lines=True)


_BOARDS_SQL = """
WITH lj AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 2 END AS rank, o_orderpriority || '/' || CAST(o_orderkey % 7 AS VARCHAR) AS title,
                   'c' || CAST(o_custkey AS VARCHAR) || '.com' AS dom,
                   CASE WHEN o_orderstatus <> 'F' THEN 'job/' || CAST(o_custkey AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) END AS url,
                   o_custkey // 20 AS doc FROM orders),
uj AS (SELECT * FROM lj QUALIFY row_number() OVER (PARTITION BY lower(dom || '_' || title) ORDER BY rank, doc, o_orderkey) = 1),
lc AS (SELECT *, 0 AS rank, 'y' AS folder, 'Y BOARD' AS ds FROM customer WHERE c_nationkey >= 10
       UNION ALL SELECT *, 1, 'x', 'companies/folder=x' FROM customer WHERE c_nationkey < 15),
kc AS (SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN 'alt' || CAST(c_custkey AS VARCHAR)
                      WHEN c_mktsegment <> 'MACHINERY' THEN 'c' || CAST(c_custkey AS VARCHAR) || '.com' END AS key,
              CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 5 END AS nj FROM lc),
rc AS (SELECT *, row_number() OVER w AS rn, first_value(folder) OVER w AS winner FROM kc WINDOW w AS (PARTITION BY key ORDER BY rank, c_custkey)),
uc AS (SELECT *, row_number() OVER (ORDER BY rank, c_custkey) AS pos, count(*) OVER () AS n FROM rc WHERE rn = 1)
"""


@query("portfolio_boards_companies", _BOARDS_SQL + """
SELECT 'cust-' || CAST(c_custkey AS VARCHAR) AS slug, folder || ' ' || c_name AS name, ds AS dataSource, CAST(nj AS BIGINT) AS numJobs, key AS company_key,
       CASE WHEN nj > 0 THEN 'with' WHEN nj = 0 THEN 'without' END AS jobs FROM uc""")
def portfolio_boards_companies(spark, sf):
    """K1, company half: two boards in declared order, the first row per domain (or fallback domain; missing ones are one key)."""
    out = _consolidated(spark, sf)
    cols = ["slug", "name", "dataSource", "numJobs", "company_key"]
    parts = [out["with_jobs"].select(*cols, F.lit("with").alias("jobs")), out["without_jobs"].select(*cols, F.lit("without").alias("jobs")),
             out["companies"].filter("numJobs IS NULL").select(*cols, F.lit(None).cast("string").alias("jobs"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("portfolio_boards_duplicates", _BOARDS_SQL + """
SELECT 'cust-' || CAST(c_custkey AS VARCHAR) AS slug, 'companies/folder=' || winner AS winner_source,
       'companies/folder=' || folder AS duplicate_source FROM rc WHERE rn > 1""")
def portfolio_boards_duplicates(spark, sf):
    """K1, company half: every losing company row with the winner's board and its own."""
    return _consolidated(spark, sf)["company_duplicates"].select("slug", "winner_source", "duplicate_source")


@query("portfolio_boards_profile", _BOARDS_SQL + """,
t AS (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY nj DESC NULLS LAST, rank, c_custkey) AS place FROM uc)
SELECT ds AS dataSource, 'total' AS what, CAST(count(*) AS BIGINT) AS companies, CAST(sum(nj) AS BIGINT) AS jobs, NULL AS slug FROM uc GROUP BY ds
UNION ALL SELECT ds, 'top', CAST(place AS BIGINT), CAST(nj AS BIGINT), 'cust-' || CAST(c_custkey AS VARCHAR) FROM t WHERE place <= 10
UNION ALL SELECT NULL, 'summary', (SELECT count(*) FROM lc), (SELECT count(*) FROM uc), NULL""")
def portfolio_boards_profile(spark, sf):
    """K1, company half: totals by board (D2), top ten by jobs (F1) and the dedupe summary."""
    out = _consolidated(spark, sf)
    total = out["source_stats"].select("dataSource", F.lit("total").alias("what"), "companies", F.col("total_jobs").alias("jobs"),
                                       F.lit(None).cast("string").alias("slug"))
    top = out["top_companies"].select("dataSource", F.lit("top").alias("what"), F.col("rank").cast("long").alias("companies"),
                                      F.col("numJobs").alias("jobs"), "slug")
    summary = out["company_summary"].select(F.lit(None).cast("string").alias("dataSource"), F.lit("summary").alias("what"),
                                            F.col("processed").alias("companies"), F.col("unique").alias("jobs"),
                                            F.lit(None).cast("string").alias("slug"))
    return total.unionByName(top).unionByName(summary)


@query("portfolio_boards_halves", _BOARDS_SQL + """
SELECT dom AS companyDomain, title, CASE WHEN uc.pos IS NULL THEN 'orphan' WHEN uc.pos <= ceil(uc.n / 2.0) THEN 'A' ELSE 'B' END AS half
FROM uj LEFT JOIN uc ON uc.key = uj.dom""")
def portfolio_boards_halves(spark, sf):
    """K1: jobs of the first and the second half of the consolidated companies, and those of neither."""
    return _consolidated(spark, sf)["job_halves"].select("companyDomain", "title", "half")


@query("portfolio_two_sources_state", _BOARDS_SQL + """,
known AS (SELECT DISTINCT c_custkey FROM uc),
own AS (SELECT uj.* FROM uj JOIN known ON c_custkey = o_custkey),
ins AS (SELECT * FROM own WHERE url IS NULL
        UNION ALL SELECT * FROM own WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey, url ORDER BY rank, doc, o_orderkey) = 1)
SELECT 'upsert' AS mode, 'cust-' || CAST(o_custkey AS VARCHAR) AS slug, title, url, o_totalprice AS minValue, o_orderstatus AS office, CAST(1 AS BIGINT) AS ids FROM own
UNION ALL SELECT 'insert', 'cust-' || CAST(o_custkey AS VARCHAR), title, url, o_totalprice, o_orderstatus, CAST(1 AS BIGINT) FROM ins""")
def portfolio_two_sources_state(spark, sf):
    """K1 → K2 over two boards whose files have the same names, in both modes: every job with its own salary range and
    office, jobs without a url included, and ids unique."""
    out = _consolidated(spark, sf)
    companies, jobs = (K.materialize(out[name], name) for name in ("companies", "jobs"))  # both loads read what was kept, not the files
    states = []
    for mode in ("upsert", "insert"):
        wh, _rejects = K.load_portfolio(K.empty_warehouse(spark), companies, jobs, mode=mode)
        c = wh["company"].select(short_id("id").alias("companyId"), "slug")
        sal = wh["salary_range"].select("jobId", "minValue")
        off = wh["job_office"].join(wh["office"].select(F.col("id").alias("officeId"), F.col("location").alias("office")), "officeId").select("jobId", "office")
        # the jobs are dealt out by id once, for the count, the salary range and the office
        j = wh["job"].select(F.col("id").alias("jobId"), short_id("companyId").alias("companyId"), "title", "url").filter("jobId IS NOT NULL")
        j = j.withColumn("ids", F.count(F.lit(1)).over(Window.partitionBy("jobId")))
        state = j.join(sal, "jobId", "left").join(off, "jobId", "left").drop("jobId").join(c, "companyId")
        # stored, so that the files of one load's joins are gone before the other's are written
        states.append(K.materialize(state.select(F.lit(mode).alias("mode"), "slug", "title", "url", "minValue", "office", "ids"), "state-rows"))
    return states[0].unionByName(states[1])
