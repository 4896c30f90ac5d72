"""Source / sink round trips, staging flatten, HTML extraction and streaming queries
(A1–A3, A5–A8, D12, I21–I24, J2, J3, L1, L2).

Round trips write the whole table to a fresh folder under the shared checkpoint folder
(``spark.checkpoint.dir``) and read it back through the landed-data readers. Landed files
are grouped by ``key div 10`` (suppliers) or ``key div 100`` — keys are unique, so a file never holds more than that many
records, whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as HT
from ..functions.jsonish import merge_links
from ..functions.rules import status_bucket
from ..operators.aggregates import counts_by
from ..operators.flatten import drop_nested, flatten_jobs
from ..operators.validate import run_outcomes
from ..session import scratch_path
from ..sources import readers as R
from ..sources import sinks as S
from ..streaming import incremental as L
from .catalog import query, table

SUPPLIER_SCHEMA = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                                T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())])


def _landed_supplier_files(spark, sf, path):
    """Write suppliers as landed files of ≤ 10 records: even buckets as bare arrays, odd
    buckets wrapped as ``{"companies": [...]}``."""
    s = table(spark, sf, "supplier").withColumn("file_key", F.floor(F.col("s_suppkey") / 10))
    S.write_json_wrapped(s.filter(F.col("file_key") % 2 == 0), f"{path}/arrays", "file_key", order=["s_suppkey"])
    S.write_json_wrapped(s.filter(F.col("file_key") % 2 == 1), f"{path}/wrapped", "file_key", wrapper="companies",
                         order=["s_suppkey"])


@query("json_roundtrip", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal,
       row_number() OVER (PARTITION BY s_suppkey // 10 ORDER BY s_suppkey) AS pos FROM supplier""")
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "landed-suppliers")
    _landed_supplier_files(spark, sf, path)
    rows, errors = R.read_wrapped_json(spark, path, "companies", SUPPLIER_SCHEMA, glob="*.txt", recursive=True)
    return rows.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", F.col("pos").cast("long").alias("pos"))


@query("source_tree", """
SELECT s_suppkey, CASE WHEN s_suppkey // 10 % 2 = 0 THEN 'src_even' ELSE 'src_odd' END AS sourceFolder,
       CASE WHEN s_suppkey // 10 % 2 = 0 THEN 'EVEN' ELSE 'src_odd' END AS dataSource,
       CASE WHEN s_suppkey // 10 % 2 = 0 THEN 1 ELSE 2 END AS source_rank FROM supplier""")
def source_tree(spark, sf):
    """A3: two source folders (one per file shape) plus one registered folder that is missing."""
    root = scratch_path(spark, "source-tree")
    s = table(spark, sf, "supplier").withColumn("file_key", F.floor(F.col("s_suppkey") / 10))
    S.write_json_wrapped(s.filter(F.col("file_key") % 2 == 0), f"{root}/src_even", "file_key", order=["s_suppkey"])
    S.write_json_wrapped(s.filter(F.col("file_key") % 2 == 1), f"{root}/src_odd", "file_key", wrapper="companies",
                         order=["s_suppkey"])
    registry = [("missing", "src_missing", "MISSING"), ("even", "src_even", "EVEN"), ("odd", "src_odd", None)]
    rows, _log, _errors = R.read_source_tree(spark, root, registry, "companies", SUPPLIER_SCHEMA, glob="*.txt", recursive=True)
    return rows.select("s_suppkey", "sourceFolder", "dataSource", "source_rank")


ENTITY_SCHEMA = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                              T.StructField("status", T.StringType())])


@query("entity_dir", """
SELECT 'sup-' || CAST(s_suppkey AS VARCHAR) AS slug,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE s_suppkey END AS s_suppkey,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS s_name,
       CASE WHEN s_acctbal < 0 THEN 'unreadable JSON' END AS error FROM supplier""")
def entity_dir(spark, sf):
    """A2: one JSON object per entity file (negative balances land as broken files)."""
    path = scratch_path(spark, "entities")
    s = table(spark, sf, "supplier")
    body = F.when(F.col("s_acctbal") < 0, F.lit("{broken")).otherwise(
        F.to_json(F.struct("s_suppkey", "s_name", F.col("s_nationkey").cast("string").alias("status"))))
    S.write_entity_dir(s.select(F.concat(F.lit("sup-"), F.col("s_suppkey").cast("string")).alias("slug"), body.alias("value")), path)
    ok, bad = R.read_entity_dir(spark, path, ".txt", ENTITY_SCHEMA, slug_from_dir="slug")
    return ok.select("slug", "s_suppkey", "s_name", F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("slug", F.lit(None).cast("long").alias("s_suppkey"), F.lit(None).cast("string").alias("s_name"),
                   F.col("reason").alias("error")))


@query("csv_union", """
SELECT CAST(c_acctbal AS DOUBLE) AS acctbal, c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment
FROM customer UNION ALL SELECT s_acctbal, s_suppkey, s_name, s_nationkey, NULL FROM supplier""")
def csv_union(spark, sf):
    from ..operators.sets import union_all_sources
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                            F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                                            F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                            F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    path = scratch_path(spark, "csv-union")
    S.write_csv_union(union_all_sources([c, s]), path)
    schema = "acctbal double, id long, name string, nationkey int, segment string"
    return spark.read.option("header", True).schema(schema).csv(path)


_STATUS_TEXT_SQL = "CASE o_orderstatus WHEN 'O' THEN ' Active ' WHEN 'F' THEN 'ACQUIRED' ELSE '' END"


@query("status_buckets", f"""
WITH s AS (SELECT o_orderkey, lower(trim(coalesce(nullif({_STATUS_TEXT_SQL}, ''), 'Unknown'))) AS st FROM orders)
SELECT o_orderkey, CASE WHEN st IN ('active', 'acquired', 'inactive') THEN st ELSE 'unknown' END AS status_bucket FROM s""")
def status_buckets(spark, sf):
    """Route rows into status folders, read them back by partition."""
    path = scratch_path(spark, "status-buckets")
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(_STATUS_TEXT_SQL).alias("status"))
    S.write_by_status(o, path)
    return spark.read.schema("o_orderkey long, status string, status_bucket string").json(path) \
        .select("o_orderkey", "status_bucket")


@query("status_skip_log", f"""
SELECT o_orderkey, 'Unknown status: unknown' AS reason FROM orders WHERE ({_STATUS_TEXT_SQL}) = ''""")
def status_skip_log(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(_STATUS_TEXT_SQL).alias("status"))
    return S.skip_log(o.withColumn("status_bucket", status_bucket(F.col("status")))).select("o_orderkey", "reason")


def _postings(spark, sf):
    """documents in nested form: one posting per text line (row-local, no collect)."""
    d = table(spark, sf, "documents")
    lines = F.transform(F.split(F.col("text"), "\n"), lambda x: F.struct(x.alias("title"), F.length(x).alias("n_chars")))
    return d.select("doc_id", F.when(F.col("source") == "src0", F.lit("")).otherwise(F.col("source")).alias("name"),
                    "lang", lines.alias("jobPostings"))


@query("staging_postings", """
WITH l AS (SELECT doc_id, CASE WHEN source = 'src0' THEN 'N/A' ELSE source END AS company, lang AS location,
                  string_split(text, chr(10)) AS parts FROM documents),
e AS (SELECT doc_id, company, location, unnest(range(1, len(parts) + 1)) AS posting_pos, unnest(parts) AS title FROM l)
SELECT doc_id AS company_slug, company, location, posting_pos, length(title) AS n_chars,
       md5(title) AS title_md5 FROM e""")
def staging_postings(spark, sf):
    jobs = flatten_jobs(_postings(spark, sf), "jobPostings",
                        {"company_slug": "doc_id", "company": "name", "location": "lang"}, name_col="name")
    return jobs.select("company_slug", "company", "location", F.col("posting_pos").cast("long").alias("posting_pos"),
                       "n_chars", F.md5("title").alias("title_md5"))


@query("staging_counts", """
SELECT doc_id, len(string_split(text, chr(10))) AS numJobs FROM documents""")
def staging_counts(spark, sf):
    return drop_nested(_postings(spark, sf), "jobPostings", "numJobs").select("doc_id", "numJobs")


VENDOR_JOB = T.StructType([T.StructField(n, T.StringType()) for n in
                           ["id_icims", "title", "posted_date", "description_short", "location", "company_name"]])


@query("vendor_postings", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, 'Order ' || CAST(o_orderkey AS VARCHAR) AS "desc",
       'Amazon.com Services' AS company, CAST(o_custkey AS VARCHAR) AS location, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
       'https://www.amazon.jobs/en/jobs/' || CAST(o_orderkey AS VARCHAR) AS url FROM orders""")
def vendor_postings(spark, sf):
    """A5: landed vendor responses (≤ 100 postings each) conformed to the common record."""
    o = table(spark, sf, "orders")
    post = F.struct(F.col("o_orderkey").cast("string").alias("id_icims"), F.col("o_orderpriority").alias("title"),
                    F.col("o_orderdate").cast("date").cast("string").alias("posted_date"),
                    F.concat(F.lit("<p>Order "), F.col("o_orderkey").cast("string"), F.lit("</p>")).alias("description_short"),
                    F.col("o_custkey").cast("string").alias("location"), F.lit("Amazon.com Services").alias("company_name"))
    responses = o.groupBy(F.floor(F.col("o_orderkey") / 100).alias("page")).agg(F.collect_list(post).alias("jobs"))
    return R.conform_vendor_postings(responses, "amazon")


def _vendor_sql(company: str, url: str, date: str = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)") -> str:
    return f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, 'Order ' || CAST(o_orderkey AS VARCHAR) AS "desc",
       '{company}' AS company, CAST(o_custkey AS VARCHAR) AS location, {date} AS date,
       '{url}' || CAST(o_orderkey AS VARCHAR) AS url FROM orders"""


def _vendor_fields(spark, sf):
    """orders with the values of a posting, as text."""
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / 100).alias("page"), key.alias("id"), F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").cast("date").cast("string").alias("date"), F.col("o_custkey").cast("string").alias("place"),
        F.concat(F.lit("<p>Order <b>"), key, F.lit("</b></p>")).alias("body"))


@query("vendor_postings_microsoft", _vendor_sql("microsoft", "https://jobs.careers.microsoft.com/global/en/job/"))
def vendor_postings_microsoft(spark, sf):
    """A5: responses whose postings lie two levels down, with nested properties."""
    post = F.struct(F.col("id").alias("jobId"), "title", F.col("date").alias("postingDate"),
                    F.struct(F.col("body").alias("description"), F.col("place").alias("primaryLocation")).alias("properties"))
    pages = _vendor_fields(spark, sf).groupBy("page").agg(F.collect_list(post).alias("jobs"))
    return R.conform_vendor_postings(
        pages.select(F.struct(F.struct("jobs").alias("result")).alias("operationResult")), "microsoft")


@query("vendor_postings_netflix", _vendor_sql("netflix", "https://jobs.netflix.com/jobs/"))
def vendor_postings_netflix(spark, sf):
    """A5: responses with ``records.postings``."""
    post = F.struct(F.col("id").alias("external_id"), F.col("title").alias("text"), F.col("date").alias("created_at"),
                    F.col("body").alias("description"), F.col("place").alias("location"))
    pages = _vendor_fields(spark, sf).groupBy("page").agg(F.collect_list(post).alias("postings"))
    return R.conform_vendor_postings(pages.select(F.struct("postings").alias("records")), "netflix")


@query("vendor_postings_google", _vendor_sql(
    "Google", "https://www.google.com/about/careers/applications/jobs/results/", "'2024-03-31'"))
def vendor_postings_google(spark, sf):
    """A5: responses that are JSON text of positional arrays, the description inside a nested one."""
    post = F.format_string('["%s","%s",null,[null,"%s"],null,null,null,null,"%s"]', "id", "title", "body", "place")
    pages = _vendor_fields(spark, sf).groupBy("page").agg(F.collect_list(post).alias("posts"))
    raw = pages.select(F.concat(F.lit("["), F.concat_ws(",", "posts"), F.lit("]")).alias("value"))
    return R.conform_vendor_postings(raw, "google", as_of="2024-03-31")


def _payload_pages(spark, sf):
    """Detail pages synthesised from suppliers: a status label and an entity-encoded
    ``data-page`` JSON attribute (absent for one nation group, broken for another)."""
    s = table(spark, sf, "supplier")
    name = F.col("s_name")
    payload = F.concat(F.lit('{"props":{"company":{"name":"'), name, F.lit('","slug":"s'), F.col("s_suppkey").cast("string"),
                       F.lit('","jobPostings":['),
                       F.concat_ws(",", F.transform(F.sequence(F.lit(1), (F.col("s_nationkey") % 4 + 1).cast("int")),
                                                    lambda i: F.concat(F.lit('{"title":"Role '), i.cast("string"),
                                                                       F.lit('","url":"/jobs/'), i.cast("string"),
                                                                       F.lit('"}')))),
                       F.lit("]}}}"))
    enc = F.replace(payload, F.lit('"'), F.lit("&quot;"))
    attr = (F.when(F.col("s_nationkey") < 3, F.lit(""))
             .when(F.col("s_nationkey") < 5, F.lit('<div data-page="{&quot;props&quot;:"></div>'))
             .otherwise(F.concat(F.lit('<div data-page="'), enc, F.lit('"></div>'))))
    status = F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(
        F.concat(F.lit('<div class="row"><span>Status:</span><span>  '),
                 F.when(F.col("s_acctbal") > 5000, F.lit("Active")).otherwise(F.lit("Public   Company")),
                 F.lit(" </span></div>")))
    return s.select("s_suppkey", F.concat(F.lit("<html><body>"), status, attr, F.lit("</body></html>")).alias("html"))


_PAYLOAD_SQL = """
WITH s AS (SELECT s_suppkey, s_nationkey, s_acctbal,
  '{"props":{"company":{"name":"' || s_name || '","slug":"s' || CAST(s_suppkey AS VARCHAR) || '","jobPostings":[' ||
  array_to_string(list_transform(range(1, s_nationkey % 4 + 2), lambda i: '{"title":"Role ' || CAST(i AS VARCHAR) || '","url":"/jobs/' || CAST(i AS VARCHAR) || '"}'), ',')
  || ']}}}' AS payload FROM supplier),
p AS (SELECT s_suppkey,
  CASE WHEN s_nationkey < 3 THEN NULL WHEN s_nationkey < 5 THEN '{"props":' ELSE payload END AS attr,
  CASE WHEN s_acctbal < 0 THEN 'Unknown' WHEN s_acctbal > 5000 THEN 'Active' ELSE 'Public Company' END AS status FROM s),
r AS (SELECT s_suppkey, status, attr, CASE WHEN attr IS NULL THEN NULL WHEN json_valid(attr) THEN attr END AS js FROM p)
"""


@query("page_payload", _PAYLOAD_SQL + """
SELECT s_suppkey, status, json_extract_string(js, '$.props.company.name') AS name,
       json_extract_string(js, '$.props.company.slug') AS slug,
       CAST(json_array_length(js, '$.props.company.jobPostings') AS INTEGER) AS n_postings,
       CASE WHEN attr IS NULL THEN 'skipped' WHEN js IS NULL THEN 'error' ELSE 'success' END AS outcome FROM r""")
def page_payload(spark, sf):
    return _page_payload(spark, sf).select("s_suppkey", "status", "name", "slug", "n_postings", "outcome")


PAYLOAD_SCHEMA = T.StructType([T.StructField("props", T.StructType([T.StructField("company", T.StructType([
    T.StructField("name", T.StringType()), T.StructField("slug", T.StringType()),
    T.StructField("jobPostings", T.ArrayType(T.StructType([T.StructField("title", T.StringType()),
                                                           T.StructField("url", T.StringType())])))]))]))])


def _page_payload(spark, sf):
    p = _payload_pages(spark, sf)
    attr = HT.data_page_attr("html")
    parsed = F.from_json(attr, PAYLOAD_SCHEMA)
    return p.select("s_suppkey", HT.status_label("html").alias("status"), attr.alias("attr"),
                    parsed["props"]["company"].alias("company")) \
        .select("s_suppkey", "status", F.col("company.name").alias("name"), F.col("company.slug").alias("slug"),
                F.size("company.jobPostings").alias("n_postings"),
                F.when(F.col("attr").isNull(), F.lit("skipped"))
                 .when(F.col("company").isNull(), F.lit("error")).otherwise(F.lit("success")).alias("outcome"))


@query("run_outcomes", _PAYLOAD_SQL + """
SELECT outcome AS status, reason, count(*) AS n FROM (
  SELECT CASE WHEN attr IS NULL THEN 'skipped' WHEN js IS NULL THEN 'error' ELSE 'success' END AS outcome,
         CASE WHEN attr IS NULL THEN 'no data-page attribute' WHEN js IS NULL THEN 'unparsable data-page' END AS reason
  FROM r) GROUP BY outcome, reason""")
def run_outcomes_q(spark, sf):
    pp = _page_payload(spark, sf).drop("status").withColumn(
        "reason", F.when(F.col("outcome") == "skipped", F.lit("no data-page attribute"))
                   .when(F.col("outcome") == "error", F.lit("unparsable data-page")))
    return run_outcomes(pp.withColumnRenamed("outcome", "status"))


def _social_pages(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey").cast("string")
    a = lambda href, txt: F.concat(F.lit('<a class="l" href="'), href, F.lit(f'">{txt}</a>'))
    html = F.concat(
        F.lit("<div>"),
        F.when(F.col("c_nationkey") < 20, a(F.concat(F.lit("https://www.linkedin.com/company/old"), k), "in")).otherwise(F.lit("")),
        a(F.concat(F.lit("https://www.c"), k, F.lit(".example.com")), "site"),
        a(F.concat(F.lit("https://www.linkedin.com/company/c"), k), "in"),
        F.when(F.col("c_mktsegment") == "BUILDING", a(F.concat(F.lit("https://twitter.com/c"), k), "tw")).otherwise(F.lit("")),
        a(F.lit("/careers"), "jobs"),
        F.when(F.col("c_acctbal") > 5000, a(F.concat(F.lit("https://github.com/c"), k), "gh")).otherwise(F.lit("")),
        F.lit("</div>"))
    return c.select("c_custkey", "c_name", "c_mktsegment", html.alias("html"))


_SOCIAL_SQL = """
WITH c AS (SELECT c_custkey, c_name, c_mktsegment, CAST(c_custkey AS VARCHAR) AS k,
  '<div>' || CASE WHEN c_nationkey < 20 THEN '<a class="l" href="https://www.linkedin.com/company/old' || CAST(c_custkey AS VARCHAR) || '">in</a>' ELSE '' END
  || '<a class="l" href="https://www.c' || CAST(c_custkey AS VARCHAR) || '.example.com">site</a>'
  || '<a class="l" href="https://www.linkedin.com/company/c' || CAST(c_custkey AS VARCHAR) || '">in</a>'
  || CASE WHEN c_mktsegment = 'BUILDING' THEN '<a class="l" href="https://twitter.com/c' || CAST(c_custkey AS VARCHAR) || '">tw</a>' ELSE '' END
  || '<a class="l" href="/careers">jobs</a>'
  || CASE WHEN c_acctbal > 5000 THEN '<a class="l" href="https://github.com/c' || CAST(c_custkey AS VARCHAR) || '">gh</a>' ELSE '' END
  || '</div>' AS html FROM customer),
h AS (SELECT c_custkey, c_name, c_mktsegment, k, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hs FROM c),
s AS (SELECT c_custkey, c_name, c_mktsegment, k,
        list_filter(hs, lambda x: x LIKE '%linkedin.com%')[-1] AS linkedin,
        list_filter(hs, lambda x: x LIKE '%twitter.com%')[-1] AS twitter,
        list_filter(hs, lambda x: x LIKE '%github.com%')[-1] AS github,
        list_filter(hs, lambda x: x LIKE 'http%' AND x NOT LIKE '%linkedin.com%' AND x NOT LIKE '%twitter.com%'
           AND x NOT LIKE '%facebook.com%' AND x NOT LIKE '%github.com%' AND x NOT LIKE '%instagram.com%'
           AND x NOT LIKE '%youtube.com%' AND x NOT LIKE '%medium.com%' AND x NOT LIKE '%crunchbase.com%'
           AND x NOT LIKE '%angel.co%')[1] AS website FROM h)
"""


@query("social_links", _SOCIAL_SQL + """
SELECT c_custkey, linkedin, twitter, github, website,
       (CASE WHEN linkedin IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN twitter IS NOT NULL THEN 1 ELSE 0 END
        + CASE WHEN github IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN website IS NOT NULL THEN 1 ELSE 0 END) AS n_links
FROM s""")
def social_links(spark, sf):
    m = HT.social_links("html")
    return _social_pages(spark, sf).select("c_custkey", m.alias("m")).select(
        "c_custkey", F.col("m")["linkedin"].alias("linkedin"), F.col("m")["twitter"].alias("twitter"),
        F.col("m")["github"].alias("github"), F.col("m")["website"].alias("website"), F.size("m").alias("n_links"))


@query("founder_records", _SOCIAL_SQL + """
SELECT c_custkey, c_name AS name,
       coalesce(linkedin, 'https://linkedin.com/in/api-' || k) AS linkedin,
       coalesce(twitter, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'https://twitter.com/api-' || k END) AS twitter
FROM s""")
def founder_records(spark, sf):
    """Founder record from API link fields, overlaid by links found on the page."""
    p = _social_pages(spark, sf)
    k = F.col("c_custkey").cast("string")
    api = F.map_filter(F.create_map(
        F.lit("linkedin"), F.concat(F.lit("https://linkedin.com/in/api-"), k),
        F.lit("twitter"), F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("https://twitter.com/api-"), k))),
        lambda kk, v: v.isNotNull())
    links = merge_links(api, HT.social_links("html"))
    rec = F.struct(F.col("c_name").alias("name"), links["linkedin"].alias("linkedin"), links["twitter"].alias("twitter"))
    return p.select("c_custkey", rec.alias("f")).select("c_custkey", "f.name", "f.linkedin", "f.twitter")


_JOB_NEEDLE = "/e"
_JOB_BASE = "https://site.example.com"


@query("job_links", f"""
WITH a AS (SELECT page_id,
             regexp_extract_all(html, '<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["''][^>]*>([^<]*)</a>', 1) AS hrefs,
             regexp_extract_all(html, '<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["''][^>]*>([^<]*)</a>', 2) AS texts FROM pages),
e AS (SELECT page_id, unnest(hrefs) AS href, unnest(texts) AS txt FROM a)
SELECT page_id, CASE WHEN href LIKE 'http%' THEN href ELSE '{_JOB_BASE}' || href END AS href, trim(txt) AS text
FROM e WHERE contains(href, '{_JOB_NEEDLE}') AND NOT suffix(href, '{_JOB_NEEDLE}')""")
def job_links(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", F.explode(HT.job_links("html", _JOB_BASE, _JOB_NEEDLE)).alias("l")) \
        .select("page_id", "l.href", "l.text")


EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                             T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                             T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


@query("stream_insert_ignore", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def stream_insert_ignore(spark, sf):
    """L1 over the events file as a stream (availableNow): one row per (user, type, day). Two events
    of one day are never more than the delay of one day apart, so the state holds about two days of
    keys — compared on the key set, which does not depend on arrival order."""
    out = scratch_path(spark, "stream-dedupe-out")
    ckpt = scratch_path(spark, "stream-dedupe-ckpt")
    stream = (spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf)
              .withColumn("day", F.to_date("ts")))
    deduped = L.stream_insert_ignore(stream, ["user_id", "event_type", "day"], "ts", "1 day")
    L.run_available_now(deduped.writeStream.format("parquet").option("path", out), ckpt)
    return spark.read.parquet(out).select("user_id", "event_type", "day")


@query("stream_upsert", """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
FROM events GROUP BY user_id""")
def stream_upsert(spark, sf):
    """L2: the events file drained by a foreachBatch upsert into a versioned table keyed by
    user (greatest event_id wins)."""
    base = scratch_path(spark, "stream-upsert-warehouse")
    ckpt = scratch_path(spark, "stream-upsert-ckpt")
    state = L.stream_upsert(spark, sf, "events.parquet", EVENT_SCHEMA, base, "user_last_event", ["user_id"],
                            "event_id", ckpt)
    return state.select("user_id", "event_id", "event_type", "value")


@query("json_source_counts", """
SELECT CAST(s_suppkey // 10 AS BIGINT) AS file_key, count(*) AS n FROM supplier GROUP BY 1""")
def json_source_counts(spark, sf):
    """D4 over landed files: records per landed file."""
    path = scratch_path(spark, "landed-suppliers-counts")
    _landed_supplier_files(spark, sf, path)
    rows, _ = R.read_wrapped_json(spark, path, "companies", SUPPLIER_SCHEMA, glob="*.txt", recursive=True)
    keyed = rows.withColumn("file_key", F.floor(F.col("s_suppkey") / 10).cast("long"))
    return counts_by(keyed, "file_key")


def _staged_orders(spark, sf):
    """orders as staged portfolio jobs with location and salary JSON in their landed forms."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey").cast("string")
    preferred = F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("array<string>")).otherwise(
        F.array(F.concat(F.lit('{"label": "'), F.col("o_orderpriority"), F.lit('"}')), F.lit("")))
    fallback = F.array(F.col("o_custkey").cast("string"), F.concat(F.lit('{"value": "V'), k, F.lit('"}')))
    salary = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.struct(
        F.when(F.col("o_orderstatus") == "P", F.lit("0")).otherwise(F.col("o_totalprice").cast("string")).alias("minValue"),
        (F.col("o_totalprice") * 2).cast("string").alias("maxValue"),
        F.when(F.col("o_orderstatus") == "O", F.lit('{"value": "USD", "label": "Dollar"}'))
         .otherwise(F.lit("EUR")).alias("currency"),
        F.when(F.col("o_orderstatus") == "O", F.lit('{"label": "Yearly"}')).otherwise(F.lit("")).alias("period")))
    return o.select(F.col("o_orderkey").alias("job_key"), F.concat(F.lit("cust-"), F.col("o_custkey").cast("string"))
                    .alias("company_slug"), preferred.alias("normalizedLocations"), fallback.alias("locations"),
                    salary.alias("salary"))


@query("staging_locations", """
WITH l AS (SELECT o_orderkey AS job_ordinal, 'cust-' || CAST(o_custkey AS VARCHAR) AS company_slug,
                  CASE WHEN o_orderstatus = 'F'
                       THEN [CAST(o_custkey AS VARCHAR), '{"value": "V' || CAST(o_orderkey AS VARCHAR) || '"}']
                       ELSE ['{"label": "' || o_orderpriority || '"}', ''] END AS arr FROM orders),
e AS (SELECT job_ordinal, company_slug, unnest(arr) AS el FROM l),
v AS (SELECT job_ordinal, company_slug,
             CASE WHEN ltrim(el) LIKE '{%' THEN coalesce(nullif(json_extract_string(el, '$.label'), ''),
                                                         nullif(json_extract_string(el, '$.value'), ''))
                  ELSE el END AS location_name FROM e)
SELECT job_ordinal, company_slug, location_name FROM v WHERE location_name IS NOT NULL AND location_name <> ''""")
def staging_locations(spark, sf):
    """Location rows per staged job (normalised list preferred), labels unwrapped."""
    from ..operators.flatten import flatten_locations
    return flatten_locations(_staged_orders(spark, sf), "job_key", "company_slug", "normalizedLocations", "locations")


@query("staging_salaries", """
WITH s AS (SELECT o_orderkey AS job_ordinal,
                  CASE WHEN o_orderstatus = 'P' THEN '0' ELSE CAST(o_totalprice AS VARCHAR) END AS mn,
                  CAST(o_totalprice * 2 AS VARCHAR) AS mx,
                  CASE WHEN o_orderstatus = 'O' THEN 'USD' ELSE 'EUR' END AS currency,
                  CASE WHEN o_orderstatus = 'O' THEN 'Yearly' END AS period
           FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT job_ordinal, CASE WHEN mn = '0' THEN NULL ELSE CAST(mn AS DOUBLE) END AS min_value,
       CAST(mx AS DOUBLE) AS max_value, currency, period FROM s""")
def staging_salaries(spark, sf):
    """At most one salary row per staged job; currency / period objects unwrapped value-first."""
    from ..operators.flatten import flatten_salaries
    return flatten_salaries(_staged_orders(spark, sf), "job_key")


@query("staging_founders", """
WITH f AS (SELECT 'sup-' || CAST(s_suppkey AS VARCHAR) AS slug, s_name AS name,
                  CASE WHEN s_acctbal < 0 THEN '' ELSE 'CEO' END AS title,
                  'in/' || CAST(s_suppkey AS VARCHAR) AS linkedin,
                  CASE WHEN s_nationkey < 10 THEN NULL ELSE '@s' || CAST(s_suppkey AS VARCHAR) END AS twitter,
                  'Founded ' || s_name || ' in nation ' || CAST(s_nationkey AS VARCHAR) || ' with a long biography text' AS bio
           FROM supplier
           UNION ALL
           SELECT 'sup-' || CAST(s_suppkey AS VARCHAR), 'Co ' || s_name, 'CTO', NULL, NULL, NULL FROM supplier)
SELECT slug, sha256(lower(coalesce(name, '') || '::' || coalesce(linkedin, '') || '::' || coalesce(twitter, '') || '::'
                          || substring(coalesce(bio, ''), 1, 50))) AS id,
       name, nullif(title, '') AS title, linkedin, twitter FROM f""")
def staging_founders(spark, sf):
    """Founders nested in company records, one row each with the deterministic id."""
    from ..operators.flatten import flatten_founders
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey").cast("string")
    first = F.struct(F.col("s_name").alias("name"),
                     F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(F.lit("CEO")).alias("title"),
                     F.concat(F.lit("Founded "), F.col("s_name"), F.lit(" in nation "), F.col("s_nationkey").cast("string"),
                              F.lit(" with a long biography text")).alias("bio"),
                     F.map_filter(F.create_map(F.lit("linkedin"), F.concat(F.lit("in/"), k),
                                               F.lit("twitter"), F.when(F.col("s_nationkey") >= 10,
                                                                        F.concat(F.lit("@s"), k))),
                                  lambda kk, v: v.isNotNull()).alias("social_links"))
    second = F.struct(F.concat(F.lit("Co "), F.col("s_name")).alias("name"), F.lit("CTO").alias("title"),
                      F.lit(None).cast("string").alias("bio"),
                      F.create_map().cast("map<string,string>").alias("social_links"))
    companies = s.select(F.concat(F.lit("sup-"), k).alias("slug"), F.array(first, second).alias("founders"))
    return flatten_founders(companies, "slug").select("slug", "id", "name", "title", "linkedin", "twitter")
