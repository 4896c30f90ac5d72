"""Loads over a warehouse with rows (K4, K6), all rules of all tables (H9), page extraction on stored pages (I21-I23),
increments (L2) and the reset (A9)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as SC
from ..functions import html as HT
from ..operators.validate import audit_warehouse
from ..session import scratch_path
from ..sources import sinks as S
from ..streaming import incremental as L
from . import jobs as K
from .catalog import query, table
from .q_directory import _DIR_SQL, AS_OF, directory_inputs
from .q_io import EVENT_SCHEMA, PAYLOAD_SCHEMA
from .q_merge import _landed_portfolio
from .q_unify import _FLAT_SQL, _flat_feed

_YC = "'https://www.ycombinator.com/companies/sup-'"


# ------------------------------------------------------------------------------------- K4 over rows
def _directory_over_rows(spark, sf):
    """Every second supplier is held under an id of its own with two jobs; a fifth of the postings name a company that nobody knows."""
    base, details, jobs = directory_inputs(spark, sf)
    fmt = K.format_directory(base, details, jobs, AS_OF)
    s = table(spark, sf, "supplier").filter(F.col("s_suppkey") % 2 == 0)
    k = F.col("s_suppkey").cast("string")
    company = s.select(F.concat(F.lit("held-"), k).alias("id"), F.concat(F.lit("sup-"), k).alias("slug"), F.lit("old").alias("name"),
                       F.lit(-1).alias("staffCount"), F.lit(99).alias("numJobs"))
    held = F.explode(F.array(
        F.struct(F.lit("1").alias("n"), F.lit("Old title").alias("title"),
                 F.concat(F.lit(K.DIRECTORY_BASE_URL + "/companies/sup-"), k, F.lit("/jobs/1")).alias("url")),
        F.struct(F.lit("2").alias("n"), F.lit("Engineering Manager").alias("title"), F.concat(F.lit("elsewhere/"), k).alias("url"))))
    job = s.select(k.alias("k"), held.alias("h")).select(
        F.concat(F.lit("hj-"), "k", F.lit("-"), "h.n").alias("id"), "h.title", "h.url", F.concat(F.lit("held-"), "k").alias("companyId"),
        F.concat(F.lit("text "), "h.n").alias("description"))
    wh = K.empty_warehouse(spark) | {"company": K.conform(company, SC.COMPANY), "job": K.conform(job, SC.JOB)}
    ghosts = fmt["jobs"].filter("posting_pos = 1 AND CAST(substring(companySlug, 5) AS BIGINT) % 5 = 0").withColumn(
        "companySlug", F.concat(F.lit("ghost-"), F.substring("companySlug", 5, 20)))
    return K.load_directory(wh, fmt["companies"], fmt["jobs"].unionByName(ghosts))


@query("directory_held_state", _DIR_SQL + f""",
k AS (SELECT kept.*, s.s_suppkey, s.np, s.s_suppkey % 2 = 0 AS held FROM kept JOIN s USING (slug)),
j AS (SELECT slug, held, title, {_YC} || CAST(s_suppkey AS VARCHAR) || '/jobs/' || CAST(i AS VARCHAR) AS url,
             CASE WHEN held AND title = 'Engineering Manager' THEN 'text 2' WHEN held AND i = 1 THEN 'text 1' END AS description,
             CASE WHEN i = 1 THEN CAST((100 + s_nationkey) * 1000 AS DOUBLE) END AS minValue FROM k
      UNION ALL SELECT slug, TRUE, 'Old title', {_YC} || CAST(s_suppkey AS VARCHAR) || '/jobs/1', 'text 1', NULL FROM s WHERE s_suppkey % 2 = 0 AND np = 3
      UNION ALL SELECT slug, TRUE, 'Engineering Manager', 'elsewhere/' || CAST(s_suppkey AS VARCHAR), 'text 2', NULL FROM s WHERE s_suppkey % 2 = 0 AND np = 1)
SELECT *, count(*) OVER (PARTITION BY slug) AS numJobs FROM j""")
def directory_held_state(spark, sf):
    """K4 into a warehouse with rows: held companies keep their ids, held jobs are found by url, then by title, and keep what the
    feed does not write; jobs that the feed does not have stay."""
    wh, _rejects = _directory_over_rows(spark, sf)
    c = wh["company"].select(F.col("id").alias("companyId"), "slug", "numJobs")
    sal = wh["salary_range"].select("jobId", "minValue")
    return (wh["job"].select(F.col("id").alias("jobId"), "companyId", "title", "url", "description").join(c, "companyId").join(sal, "jobId", "left")
            .select("slug", F.col("companyId").startswith("held-").alias("held"), "title", "url", "description", "minValue", "numJobs"))


@query("directory_unknown_parents", """
SELECT 'job' AS kind, 'ghost-' || CAST(s_suppkey AS VARCHAR) AS key, 'unknown company' AS reason FROM supplier WHERE s_suppkey % 5 = 0""")
def directory_unknown_parents(spark, sf):
    """B2 in K4: postings of companies that neither the feed nor the warehouse has."""
    return _directory_over_rows(spark, sf)[1]


# ------------------------------------------------------------------------------------- K6 over shared companies and jobs
@query("unified_rows", _DIR_SQL + "," + _FLAT_SQL.replace("WITH f AS", "f AS", 1).replace("kept AS", "flat AS", 1).replace(
    "FROM kept", "FROM flat") + """,
port AS (SELECT 'cust-' || CAST(o_custkey AS VARCHAR) AS slug, o_orderpriority AS title, 'job/' || CAST(o_orderkey AS VARCHAR) AS url FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) = 1),
d AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'cust-' || CAST(s_suppkey AS VARCHAR) ELSE kept.slug END AS slug,
             CASE WHEN i = 2 THEN '1-URGENT' ELSE title END AS title, """ + _YC + """ || CAST(s_suppkey AS VARCHAR) || '/jobs/' || CAST(i AS VARCHAR) AS url
      FROM kept JOIN s USING (slug)),
u AS (SELECT port.*, NULL AS source FROM port WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.slug = port.slug AND d.title = port.title)
      UNION ALL SELECT CASE WHEN employer = 'Amazon' THEN 'cust-7' ELSE lower(employer) END, title, url, 'SQLITE_IMPORT' FROM flat
      UNION ALL SELECT *, 'YC' FROM d)
SELECT *, count(*) OVER (PARTITION BY slug) AS numJobs FROM u""")
def unified_rows(spark, sf):
    """K6 with feeds that share companies and jobs, row by row: a third of the directory's companies are customers of the portfolio, one of
    their postings is a job the portfolio has under the same title, and an employer of the flat feed is a portfolio company by name."""
    companies, jobs = _landed_portfolio(spark, sf)
    companies = companies.withColumn("name", F.when(F.col("slug") == "cust-7", F.lit("Amazon")).otherwise(F.col("name")))
    base, details, pages = directory_inputs(spark, sf)
    number = F.substring("slug", 5, 20)
    shared = F.when(number.cast("bigint") % 3 == 0, F.concat(F.lit("cust-"), number)).otherwise(F.col("slug"))
    fmt = K.format_directory(*[df.withColumn("slug", shared) for df in (base, details, pages)], AS_OF)
    posted = fmt["jobs"].withColumn("title", F.when(F.col("title") == "Engineering Manager", F.lit("1-URGENT")).otherwise(F.col("title")))
    wh = K.unify(K.empty_warehouse(spark), (companies, jobs), _flat_feed(spark, sf, F.col("o_orderstatus")), (fmt["companies"], posted), as_of=AS_OF)
    c = wh["company"].select(F.col("id").alias("companyId"), "slug", "numJobs")
    return wh["job"].join(c, "companyId").select("slug", "title", "url", F.col("dataSource").alias("source"), "numJobs")


# ------------------------------------------------------------------------------------- H9, all tables
# table → (source, columns in words both engines read, condition)
_TABLES = {
    "company": ("customer", ["'c' || c_custkey AS id", "CASE WHEN c_acctbal >= 0 THEN c_name END AS name",
                             "CASE WHEN c_nationkey <> 3 THEN 's' || CAST(floor(c_custkey / 2) AS BIGINT) END AS slug", "0 AS numJobs",
                             "FALSE AS isFeatured", "CASE WHEN c_nationkey <> 4 THEN FALSE END AS isRemoteFriendly"], "TRUE"),
    "market": ("part", ["'m' || (p_partkey % 500) AS id", "CASE WHEN p_size > 2 THEN p_name END AS name"], "TRUE"),
    "stage": ("supplier", ["'st' || s_suppkey AS id", "'N' || s_nationkey AS name"], "TRUE"),
    "office": ("supplier", ["CAST(s_suppkey AS STRING) AS id", "'NATION_' || s_nationkey AS location"], "s_acctbal >= 0"),
    "investor": ("supplier", ["'i' || s_suppkey AS id", "CASE WHEN s_acctbal >= 0 THEN 'V' || (s_suppkey % 40) END AS name",
                              "'sl' || CAST(floor(s_suppkey / 2) AS BIGINT) AS slug"], "TRUE"),
    "founder": ("part", ["'f' || p_partkey AS id", "CASE WHEN p_size > 1 THEN p_type END AS name",
                         "CASE WHEN p_size > 25 THEN p_brand END AS linkedin"], "TRUE"),
    "company_market": ("orders", ["'c' || o_custkey AS companyId", "'m' || (o_orderkey % 600) AS marketId"], "TRUE"),
    "company_stage": ("customer", ["'c' || c_custkey AS companyId", "'st' || (c_nationkey * 10) AS stageId"], "TRUE"),
    "company_office": ("customer", ["CASE WHEN c_acctbal >= 0 THEN 'c' || c_custkey END AS companyId", "CAST(c_nationkey AS STRING) AS officeId"], "TRUE"),
    "company_investor": ("orders", ["'c' || (o_custkey + 1) AS companyId", "'i' || (o_orderkey % 120) AS investorId"], "TRUE"),
    "company_founder": ("lineitem", ["'c' || l_suppkey AS companyId", "'f' || l_partkey AS founderId"], "TRUE"),
    "job": ("orders", ["CAST(o_orderkey AS STRING) AS id", "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS title",
                       "CASE WHEN o_orderstatus <> 'O' THEN 'u' || o_custkey END AS url",
                       "'c' || (CASE WHEN o_orderstatus = 'P' THEN -o_custkey - 1 ELSE o_custkey END) AS companyId", "FALSE AS remote",
                       "FALSE AS hybrid", "FALSE AS manager", "FALSE AS consultant", "CASE WHEN o_orderkey % 9 <> 0 THEN FALSE END AS contractor",
                       "'COMPLETE' AS dataCompleteness"], "TRUE"),
    "job_office": ("lineitem", ["CAST(l_orderkey AS STRING) AS jobId", "CAST(l_suppkey AS STRING) AS officeId"], "TRUE"),
    "salary_range": ("orders", ["'x' || CAST(floor(o_orderkey / 3) AS BIGINT) AS id",
                                "CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING) END AS jobId"], "TRUE"),
}


def _rules_sql() -> str:
    """One plain statement per rule."""
    out = []
    for t, cols in SC.REQUIRED.items():
        out += [f"SELECT '{t}' AS table_name, 'not_null({c})' AS rule, NULL AS key_value, count(*) AS n FROM {t} WHERE {c} IS NULL" for c in cols]
    for t, found in SC.UNIQUE.items():
        for keys in found:
            given = " AND ".join(f"{k} IS NOT NULL" for k in keys)
            out.append(f"SELECT '{t}', 'unique({','.join(keys)})', {" || '|' || ".join(keys)}, count(*) FROM {t} WHERE {given} "
                       f"GROUP BY {', '.join(keys)} HAVING count(*) > 1")
    for t, found in SC.FOREIGN.items():
        out += [f"SELECT '{t}', 'fk({c})', {c}, count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pk} FROM {parent}) GROUP BY {c}"
                for c, (parent, pk) in found.items()]
    tables = ",\n".join(f"{t} AS (SELECT {', '.join(cols)} FROM {source} WHERE {where})" for t, (source, cols, where) in _TABLES.items())
    return f"WITH {tables}\nSELECT * FROM (" + "\nUNION ALL ".join(out) + ") WHERE n > 0"


@query("audit_all_tables", _rules_sql())
def audit_all_tables(spark, sf):
    """H9: the rules of all fourteen tables, every table with rows and with broken rules."""
    wh = {t: K.conform(table(spark, sf, source).filter(where).selectExpr(*cols), SC.WAREHOUSE[t]) for t, (source, cols, where) in _TABLES.items()}
    return audit_warehouse(wh, SC.REQUIRED, SC.UNIQUE, SC.FOREIGN)


# ------------------------------------------------------------------------------------- stored pages
def _planted_pages(spark, sf):
    """The stored pages with markup planted behind them: a data-page attribute (missing on some, broken on others) with every kind of
    character reference, links in both quote styles, nested anchor text."""
    p = table(spark, sf, "pages")
    i = F.col("page_id")
    k = i.cast("string")
    # a doubly written reference must come out once decoded
    json = F.concat(F.lit('{"props":{"company":{"name":"P'), k, F.lit(' é & \\"Q\\" &quot; <x>","slug":"s'), k, F.lit('","jobPostings":['),
                    F.array_join(F.transform(F.sequence(F.lit(1), (i % 4 + 1).cast("int")), lambda n: F.concat(F.lit('{"title":"Role '), n.cast("string"), F.lit('"}'))), ","),
                    F.lit("]}}}"))
    json = F.when(i % 7 == 1, F.lit('{"props":{"company":')).otherwise(json)
    text = F.replace(json, F.lit("&"), F.lit("&amp;"))
    for char, forms in (('"', ("&quot;", "&#34;", "&#x22;")), ("é", ("&eacute;", "&#233;", "&#Xe9;")), ("<", ("&lt;", "&#60;", "&#x3C;"))):
        text = F.when(i % 3 == 0, F.replace(text, F.lit(char), F.lit(forms[0]))).when(i % 3 == 1, F.replace(text, F.lit(char), F.lit(forms[1]))) \
            .otherwise(F.replace(text, F.lit(char), F.lit(forms[2])))
    quote = F.when(i % 2 == 0, F.lit('"')).otherwise(F.lit("'"))
    attr = F.when(i % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("<div id=app data-page="), quote, text, quote, F.lit("></div>")))
    status = F.when(i % 5 != 0, F.concat(F.lit("<span>Status:</span> <span class=s>\n Public "), F.lit("\t Co</span>"))).otherwise(F.lit(""))
    links = F.concat(F.lit("<a data-href=\"https://facebook.com/no\" href=\"/home\">home</a><a href=\"https://www.linkedin.com/old\">in</a>"),
                     F.lit("<A class=x HREF='https://www.linkedin.com/company/p"), k, F.lit("?a=1&amp;b=&quot;2'>in</A>"),
                     F.when(i % 2 == 0, F.concat(F.lit("<a href=\"https://site"), k, F.lit(".example.com/?q=a&#38;r\">site</a>"))).otherwise(F.lit("")),
                     F.when(i % 3 == 0, F.concat(F.lit("<a href='https://twitter.com/t"), k, F.lit("'>t</a>"))).otherwise(F.lit("")),
                     F.lit("<a href='/jobs/"), k, F.lit("' class=\"j\"><b>Dev</b> &amp; <i>Ops</i></a><a href=\"/jobs/\">all</a>"),
                     F.lit("<a href=\"https://boards.example.org/jobs/"), k, F.lit("?x=1&amp;y=2\"> Lead </a>"))
    return p.select("page_id", F.col("html").alias("own"), F.concat("html", status, attr, links).alias("html"))


@query("page_payload_pages", """
SELECT page_id, CASE WHEN page_id % 5 <> 0 THEN 'Public Co' ELSE 'Unknown' END AS status,
       CASE WHEN page_id % 7 > 1 THEN 'P' || CAST(page_id AS VARCHAR) || ' é & "Q" &quot; <x>' END AS name,
       CASE WHEN page_id % 7 > 1 THEN 's' || CAST(page_id AS VARCHAR) END AS slug,
       CASE WHEN page_id % 7 > 1 THEN CAST(page_id % 4 + 1 AS INTEGER) END AS n_postings,
       CASE page_id % 7 WHEN 0 THEN 'no data-page attribute' WHEN 1 THEN 'unparsable data-page' END AS error FROM pages""")
def page_payload_pages(spark, sf):
    """I21 over the stored pages: typed payload, status label and an error column."""
    p = _planted_pages(spark, sf).select("page_id", HT.status_label("html").alias("status"), HT.data_page_attr("html").alias("attr"))
    p = p.select("page_id", "status", HT.page_payload("attr", PAYLOAD_SCHEMA).alias("p"))
    return p.select("page_id", "status", F.col("p.data.props.company.name").alias("name"), F.col("p.data.props.company.slug").alias("slug"),
                    F.size("p.data.props.company.jobPostings").alias("n_postings"), F.col("p.error").alias("error"))


@query("social_links_pages", """
SELECT page_id, 'https://www.linkedin.com/company/p' || CAST(page_id AS VARCHAR) || '?a=1&b="2' AS linkedin,
       CASE WHEN page_id % 3 = 0 THEN 'https://twitter.com/t' || CAST(page_id AS VARCHAR) END AS twitter, CAST(NULL AS VARCHAR) AS facebook,
       CASE WHEN page_id % 2 = 0 THEN 'https://site' || CAST(page_id AS VARCHAR) || '.example.com/?q=a&r'
            ELSE 'https://boards.example.org/jobs/' || CAST(page_id AS VARCHAR) || '?x=1&y=2' END AS website,
       CAST(length(html) - length(replace(html, '<a href="', '<a href=')) + 6 + (page_id % 2 = 0)::INT + (page_id % 3 = 0)::INT AS INTEGER) AS n_hrefs
FROM pages""")
def social_links_pages(spark, sf):
    """I22 over the stored pages and planted links: last match per site, first other http link as the website, hrefs of anchors counted."""
    m = HT.social_links("html")
    p = _planted_pages(spark, sf).select("page_id", m.alias("m"), F.size(HT.hrefs("html")).alias("n_hrefs"))
    return p.select("page_id", *[F.col("m")[k].alias(k) for k in ("linkedin", "twitter", "facebook", "website")], "n_hrefs")


@query("job_links_pages", """
SELECT page_id, 'https://base.example.com/jobs/' || CAST(page_id AS VARCHAR) AS href, 'Dev & Ops' AS text FROM pages
UNION ALL SELECT page_id, 'https://boards.example.org/jobs/' || CAST(page_id AS VARCHAR) || '?x=1&y=2', 'Lead' FROM pages""")
def job_links_pages(spark, sf):
    """I23 over the stored pages and planted job anchors: markup inside the anchor, both quote styles, relative and absolute links."""
    p = _planted_pages(spark, sf)
    return p.select("page_id", F.explode(HT.job_links("html", "https://base.example.com")).alias("l")).select("page_id", "l.href", "l.text")


# ------------------------------------------------------------------------------------- L2 and A9
@query("stream_upsert_increments", """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
FROM events GROUP BY user_id""")
def stream_upsert_increments(spark, sf):
    """L2 over events landed as several files, a micro-batch each, into a bucketed state: only touched buckets are rewritten."""
    landing = scratch_path(spark, "events-landed")
    table(spark, sf, "events").select(*EVENT_SCHEMA.names).repartitionByRange(4, "event_id").write.parquet(landing)
    schema = T.StructType([EVENT_SCHEMA[c] for c in ("user_id", "event_id", "event_type", "value")])
    state = L.BucketedState(spark, scratch_path(spark, "events-state"), "user_last_event", schema, ["user_id"], "event_id", 16)
    return L.stream_upsert_increments(spark, landing, "*.parquet", state, scratch_path(spark, "events-ckpt"), max_files_per_trigger=1)


@query("reset_warehouse", """
SELECT 'company' AS table_name, (SELECT count(*) FROM customer) AS before, CAST(0 AS BIGINT) AS after
UNION ALL SELECT 'job', (SELECT count(*) FROM orders), 0 UNION ALL SELECT 'founder', (SELECT count(*) FROM part), 0
UNION ALL SELECT 'job_office', (SELECT count(*) FROM lineitem), 0""")
def reset_warehouse(spark, sf):
    """Tables committed, reset and read again: empty with their columns, founders included; the versions before stay."""
    base = scratch_path(spark, "reset")
    tables = {"company": table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
              "job": table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title")),
              "founder": table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
              "job_office": table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("jobId"), F.col("l_suppkey").alias("officeId"))}
    for name, df in tables.items():
        S.commit_version(K.conform(df, SC.WAREHOUSE[name]), base, name)
    S.reset_warehouse(spark, base, SC.WAREHOUSE)
    out = None
    for name in tables:
        first = S.list_versions(spark, base, name)[0]
        before = spark.read.parquet(f"{base}/{name}/v={first}").agg(F.count(F.lit(1)).alias("before"))
        after = S.read_current(spark, base, name, SC.WAREHOUSE[name]).select(*SC.WAREHOUSE[name].names).agg(F.count(F.lit(1)).alias("after"))
        row = before.select(F.lit(name).alias("table_name"), "before", F.lit(None).cast("long").alias("after")).unionByName(
            after.select(F.lit(name).alias("table_name"), F.lit(None).cast("long").alias("before"), "after"))
        out = row if out is None else out.unionByName(row)
    return out.groupBy("table_name").agg(F.max("before").alias("before"), F.max("after").alias("after"))
