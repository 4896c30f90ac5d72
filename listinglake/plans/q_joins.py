"""Join, set, identity and diff queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import slugify
from ..operators import identity as ID
from ..operators import joins as J
from ..operators import sets as G
from ..operators.diff import compare_snapshots, diff_counts
from ..operators.flatten import flatten_links, zip_parallel
from ..operators.split import company_halves, split_halves
from ..operators.validate import audit_constraints, audit_warehouse, fk_violations, unique_violations
from .bindings import _URL_SQL, _job_url, founders
from .catalog import query, table


@query("dim_market", "SELECT DISTINCT c_mktsegment AS name, sha256(c_mktsegment) AS id FROM customer")
def dim_market(spark, sf):
    return G.build_dimension(table(spark, sf, "customer"), "c_mktsegment", out_key="name")


def _staged_markets(spark, sf):
    """Each job (order) stages its company's market: (name, company_slug), many repeats."""
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_mktsegment").alias("name"), F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("company_slug"))


@query("bridge_company_market", """
SELECT DISTINCT c.c_custkey AS companyId, sha256(c.c_mktsegment) AS dimId
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def bridge_company_market(spark, sf):
    dim = G.build_dimension(table(spark, sf, "customer"), "c_mktsegment", out_key="name")
    company = table(spark, sf, "customer").select(
        F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("slug"), F.col("c_custkey").alias("id"))
    return J.link(_staged_markets(spark, sf), dim, company)


@query("office_union", """
SELECT n_name AS name FROM nation UNION SELECT r_name FROM region
UNION SELECT r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def office_union(spark, sf):
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    via = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("name"))
    return G.union_distinct([n.select(F.col("n_name").alias("name")), r.select(F.col("r_name").alias("name")), via],
                            "name")


@query("market_concat", """
SELECT p_partkey, market FROM (SELECT p_partkey, unnest([p_brand, nullif(p_type, 'SMALL'), p_name]) AS market FROM part)
WHERE market IS NOT NULL AND market <> ''""")
def market_concat(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", G.concat_arrays(F.array(F.col("p_brand"), F.nullif(F.col("p_type"), F.lit("SMALL"))),
                                     F.array(F.col("p_name"))).alias("markets"))
    return flatten_links(p, "p_partkey", "markets", out="market")


@query("union_feeds", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def union_feeds(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                            F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                                            F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                            F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return G.union_all_sources([c, s])


@query("investor_zip", r"""
SELECT n_nationkey, 1 AS pos, n_name AS investor_name,
       substring(regexp_replace(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), 1, 100) AS investor_slug
FROM nation
UNION ALL
SELECT n.n_nationkey, 2, r.r_name, regexp_replace(lower(r.r_name), '[^a-z0-9]+', '-', 'g')
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def investor_zip(spark, sf):
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    rows = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.array(F.col("n_name"), F.col("r_name")).alias("investors"),
        F.array(slugify(F.col("n_name"))).alias("investorSlugs"))
    return zip_parallel(rows, "n_nationkey", "investors", "investorSlugs").withColumn("pos", F.col("pos").cast("int"))


@query("enrich_left", """
SELECT d.doc_id AS slug,
       CASE WHEN l.status IS NOT NULL AND l.status <> '' THEN l.status ELSE d.source END AS status,
       CASE WHEN l.location IS NOT NULL AND l.location <> '' THEN l.location ELSE d.lang END AS location,
       p.url AS jobUrl
FROM documents d
LEFT JOIN (SELECT doc_id, CASE WHEN quality = 1 THEN 'Active' ELSE '' END AS status,
                  CASE WHEN toxic = 1 THEN 'remote' END AS location FROM labels) l ON l.doc_id = d.doc_id
LEFT JOIN pages p ON p.page_id = d.doc_id""")
def enrich_left(spark, sf):
    base = table(spark, sf, "documents").select(F.col("doc_id").alias("slug"), F.col("source").alias("status"),
                                                F.col("lang").alias("location"))
    details = table(spark, sf, "labels").select(
        F.col("doc_id").alias("slug"),
        F.when(F.col("quality") == 1, F.lit("Active")).otherwise(F.lit("")).alias("d_status"),
        F.when(F.col("toxic") == 1, F.lit("remote")).alias("d_location"))
    jobs = table(spark, sf, "pages").select(F.col("page_id").alias("slug"), F.col("url").alias("jobUrl"))
    return J.enrich_left(base, details, jobs, "slug",
                         overrides={"status": ("d_status", "status"), "location": ("d_location", "location")})


@query("two_tier_match", f"""
WITH e AS (SELECT o_orderkey AS id, o_custkey AS companyId, {_URL_SQL} AS url, o_orderpriority AS title
           FROM orders WHERE o_orderstatus IN ('F', 'O')),
s AS (SELECT o_orderkey AS staged_id, o_custkey AS companyId,
             CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE {_URL_SQL} END AS url, o_orderpriority AS title
      FROM orders WHERE o_orderstatus IN ('O', 'P')),
m AS (SELECT s.staged_id,
             (SELECT min(e.id) FROM e WHERE e.companyId = s.companyId AND e.url = s.url AND s.url <> '') AS uid,
             (SELECT min(e.id) FROM e WHERE e.companyId = s.companyId AND e.title = s.title) AS tid FROM s)
SELECT staged_id, coalesce(uid, tid) AS matched_id,
       CASE WHEN uid IS NOT NULL THEN 1 WHEN tid IS NOT NULL THEN 2 END AS match_tier FROM m""")
def two_tier_match(spark, sf):
    o = table(spark, sf, "orders")
    existing = o.filter(F.col("o_orderstatus").isin("F", "O")).select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("companyId"), _job_url().alias("url"),
        F.col("o_orderpriority").alias("title"))
    staged = o.filter(F.col("o_orderstatus").isin("O", "P")).select(
        F.col("o_orderkey").alias("staged_id"), F.col("o_custkey").alias("companyId"),
        _job_url(F.col("o_orderpriority") != "5-LOW").alias("url"), F.col("o_orderpriority").alias("title"))
    return J.two_tier_match(staged, existing).select("staged_id", "matched_id", "match_tier")


_SNAP_SQL = f"""
WITH a AS (SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE {_URL_SQL} END AS url,
                  CASE WHEN o_orderpriority = '3-MEDIUM' THEN '' ELSE o_orderpriority END AS company
           FROM orders WHERE o_orderstatus IN ('F', 'O')),
b AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey + 100000000 ELSE o_orderkey END AS id,
             CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE {_URL_SQL} END AS url,
             CASE WHEN o_orderpriority = '3-MEDIUM' THEN '' ELSE o_orderpriority END AS company, o_orderkey AS ord
      FROM orders WHERE o_orderstatus IN ('O', 'P')),
bu AS (SELECT url, arg_max(id, ord) AS bid FROM b WHERE url IS NOT NULL AND url <> '' GROUP BY url),
d AS (
SELECT 'by_id' AS kind, a.id, a.id AS other_id, a.company FROM a WHERE a.id IN (SELECT id FROM b)
UNION ALL SELECT 'by_url', a.id, bu.bid, a.company FROM a JOIN bu ON a.url = bu.url WHERE a.id NOT IN (SELECT id FROM b)
UNION ALL SELECT 'only_a', a.id, NULL, a.company FROM a
  WHERE a.id NOT IN (SELECT id FROM b) AND (a.url IS NULL OR a.url = '' OR a.url NOT IN (SELECT url FROM bu))
UNION ALL SELECT 'only_b', b.id, NULL, b.company FROM b
  WHERE b.id NOT IN (SELECT id FROM a)
    AND (b.url IS NULL OR b.url = '' OR b.url NOT IN (SELECT url FROM a WHERE url IS NOT NULL AND url <> '')))
"""


def _snapshots(spark, sf):
    o = table(spark, sf, "orders")
    url = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", _job_url())
    company = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("")).otherwise(F.col("o_orderpriority"))
    a = o.filter(F.col("o_orderstatus").isin("F", "O")).select(
        F.col("o_orderkey").alias("id"), url.alias("url"), company.alias("company"))
    b = o.filter(F.col("o_orderstatus").isin("O", "P")).select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey") + 100000000)
         .otherwise(F.col("o_orderkey")).alias("id"),
        url.alias("url"), company.alias("company"), F.col("o_orderkey").alias("ord"))
    return a, b


@query("snapshot_diff", _SNAP_SQL + "SELECT kind, id, other_id, company FROM d")
def snapshot_diff(spark, sf):
    a, b = _snapshots(spark, sf)
    return compare_snapshots(a, b, b_order="ord")


@query("snapshot_diff_counts", _SNAP_SQL + """
SELECT kind, company, count(*) AS n FROM
  (SELECT kind, CASE WHEN company IS NULL OR company = '' THEN 'Unknown' ELSE company END AS company FROM d)
GROUP BY ROLLUP (kind, company) HAVING kind IS NOT NULL""")
def snapshot_diff_counts(spark, sf):
    a, b = _snapshots(spark, sf)
    return diff_counts(compare_snapshots(a, b, b_order="ord"))


def _non_building(spark, sf):
    return table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING")


@query("orphans_childless", """
SELECT 'orphan' AS kind, o_orderkey AS key FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
UNION ALL
SELECT 'childless', c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'
  AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def orphans_childless(spark, sf):
    o = table(spark, sf, "orders")
    c = _non_building(spark, sf)
    orph = J.orphans(o, c, "o_custkey", "c_custkey").select(F.lit("orphan").alias("kind"), F.col("o_orderkey").alias("key"))
    child = J.childless(c, o.filter(F.col("o_orderstatus") == "P"), "c_custkey", "o_custkey") \
        .select(F.lit("childless").alias("kind"), F.col("c_custkey").alias("key"))
    return orph.unionByName(child)


@query("orphan_values", """
SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def orphan_values(spark, sf):
    from ..operators.aggregates import distinct_values
    return distinct_values(J.orphans(table(spark, sf, "orders"), _non_building(spark, sf), "o_custkey", "c_custkey"),
                           "o_custkey")


_HALVES_SQL = """
WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS pos, count(*) OVER () AS n
           FROM customer WHERE c_mktsegment <> 'BUILDING'),
h AS (SELECT c_custkey, CASE WHEN pos <= ceil(n / 2.0) THEN 'A' ELSE 'B' END AS half FROM c)
"""


@query("split_halves", _HALVES_SQL + """
SELECT o.o_orderkey, o.o_custkey, coalesce(h.half, 'orphan') AS half FROM orders o LEFT JOIN h ON h.c_custkey = o.o_custkey""")
def split_halves_q(spark, sf):
    jobs = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return split_halves(_non_building(spark, sf).select("c_custkey"), jobs, ["c_custkey"], "c_custkey", "o_custkey")


@query("split_halves_companies", _HALVES_SQL + "SELECT c_custkey, half FROM h")
def split_halves_companies(spark, sf):
    return company_halves(_non_building(spark, sf).select("c_custkey"), ["c_custkey"]).select("c_custkey", "half")


_FOUNDERS_SQL = """
WITH f AS (SELECT p_partkey AS id, p_name AS name,
                  CASE WHEN p_size <= 10 THEN NULL WHEN p_size <= 15 THEN ''
                       ELSE 'linkedin.com/in/' || p_brand || '-' || CAST(p_size AS VARCHAR) END AS linkedin,
                  CASE WHEN p_size > 40 THEN NULL ELSE '@' || p_type || CAST(p_size AS VARCHAR) END AS twitter,
                  CASE WHEN p_retailprice > 1500 THEN 'bio ' || CAST(p_partkey AS VARCHAR) END AS bio,
                  CASE WHEN p_size <= 25 THEN p_type ELSE '' END AS title FROM part),
l AS (SELECT id, min(id) OVER (PARTITION BY name, linkedin) AS dup_of, 'linkedin' AS via FROM f
      WHERE name IS NOT NULL AND name <> '' AND linkedin IS NOT NULL AND linkedin <> ''),
t AS (SELECT id, min(id) OVER (PARTITION BY name, twitter) AS dup_of, 'twitter' AS via FROM f
      WHERE name IS NOT NULL AND name <> '' AND twitter IS NOT NULL AND twitter <> ''),
e AS (SELECT * FROM l WHERE id <> dup_of UNION ALL SELECT * FROM t WHERE id <> dup_of)
"""


@query("founder_pairs", _FOUNDERS_SQL + "SELECT id, dup_of, via FROM e")
def founder_pairs(spark, sf):
    return ID.duplicate_links(founders(spark, sf))


_MERGE_SQL = _FOUNDERS_SQL.replace("WITH f AS", "WITH RECURSIVE f AS") + """,
u AS (SELECT id AS a, dup_of AS b FROM e UNION SELECT dup_of, id FROM e),
reach(v, lbl) AS (SELECT id, id FROM f UNION SELECT u.a, r.lbl FROM reach r JOIN u ON u.b = r.v),
comp AS (SELECT v AS id, min(lbl) AS component FROM reach GROUP BY v),
sc AS (SELECT f.id, comp.component,
              (CASE WHEN name IS NOT NULL AND name <> '' THEN 1 ELSE 0 END
             + CASE WHEN linkedin IS NOT NULL AND linkedin <> '' THEN 1 ELSE 0 END
             + CASE WHEN twitter IS NOT NULL AND twitter <> '' THEN 1 ELSE 0 END
             + CASE WHEN bio IS NOT NULL AND bio <> '' THEN 1 ELSE 0 END
             + CASE WHEN title IS NOT NULL AND title <> '' THEN 1 ELSE 0 END) AS score
       FROM f JOIN comp ON f.id = comp.id),
best AS (SELECT component, first(id ORDER BY score DESC, id) AS new_id FROM sc GROUP BY component),
mp AS (SELECT sc.id AS old_id, best.new_id FROM sc JOIN best ON sc.component = best.component)
"""


def _merge(spark, sf):
    bridge = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("founderId"),
                                                 F.col("l_suppkey").alias("companyId"))
    return ID.merge_founders(founders(spark, sf), bridge)


@query("founder_merge", _MERGE_SQL + "SELECT old_id, new_id FROM mp")
def founder_merge(spark, sf):
    return _merge(spark, sf)[2]


@query("founder_bridge_rewired", _MERGE_SQL + """
SELECT DISTINCT mp.new_id AS founderId, l.l_suppkey AS companyId FROM lineitem l JOIN mp ON l.l_partkey = mp.old_id""")
def founder_bridge_rewired(spark, sf):
    return _merge(spark, sf)[1].select("founderId", "companyId")


@query("audit_constraints", """
SELECT 'lineitem' AS table_name, 'unique(l_orderkey,l_linenumber)' AS rule,
       CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key_value, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'lineitem', 'fk(l_orderkey)', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""")
def audit_constraints_q(spark, sf):
    li = table(spark, sf, "lineitem")
    live = table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return audit_constraints([unique_violations(li, "lineitem", ["l_orderkey", "l_linenumber"]),
                              fk_violations(li, "lineitem", "l_orderkey", live, "o_orderkey")])


@query("audit_warehouse", """
WITH company AS (SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal >= 0 THEN c_name END AS name,
                        's' || CAST(c_custkey // 2 AS VARCHAR) AS slug FROM customer),
office AS (SELECT s_suppkey AS id, 'NATION_' || CAST(s_nationkey AS VARCHAR) AS location FROM supplier WHERE s_acctbal >= 0),
job AS (SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS title,
               CASE WHEN o_orderstatus <> 'O' THEN 'u' || CAST(o_custkey AS VARCHAR) END AS url,
               'c' || CAST(CASE WHEN o_orderstatus = 'P' THEN -o_custkey - 1 ELSE o_custkey END AS VARCHAR) AS companyId
        FROM orders),
job_office AS (SELECT l_orderkey AS jobId, l_suppkey AS officeId FROM lineitem),
salary_range AS (SELECT o_orderkey AS id, o_orderkey // 2 AS jobId FROM orders),
v AS (
  SELECT 'company' AS table_name, 'not_null(name)' AS rule, NULL AS key_value, count(*) AS n FROM company WHERE name IS NULL
  UNION ALL SELECT 'job', 'not_null(title)', NULL, count(*) FROM job WHERE title IS NULL
  UNION ALL SELECT 'company', 'unique(slug)', slug, count(*) FROM company GROUP BY slug HAVING count(*) > 1
  UNION ALL SELECT 'office', 'unique(location)', location, count(*) FROM office GROUP BY location HAVING count(*) > 1
  UNION ALL SELECT 'job', 'unique(url,companyId)', url || '|' || companyId, count(*) FROM job WHERE url IS NOT NULL
            GROUP BY url, companyId HAVING count(*) > 1
  UNION ALL SELECT 'job_office', 'unique(jobId,officeId)', CAST(jobId AS VARCHAR) || '|' || CAST(officeId AS VARCHAR), count(*)
            FROM job_office GROUP BY jobId, officeId HAVING count(*) > 1
  UNION ALL SELECT 'salary_range', 'unique(jobId)', CAST(jobId AS VARCHAR), count(*) FROM salary_range
            GROUP BY jobId HAVING count(*) > 1
  UNION ALL SELECT 'job', 'fk(companyId)', companyId, count(*) FROM job
            WHERE companyId NOT IN (SELECT id FROM company) GROUP BY companyId
  UNION ALL SELECT 'job_office', 'fk(jobId)', CAST(jobId AS VARCHAR), count(*) FROM job_office
            WHERE jobId NOT IN (SELECT id FROM job) GROUP BY jobId
  UNION ALL SELECT 'job_office', 'fk(officeId)', CAST(officeId AS VARCHAR), count(*) FROM job_office
            WHERE officeId NOT IN (SELECT id FROM office) GROUP BY officeId
  UNION ALL SELECT 'salary_range', 'fk(jobId)', CAST(jobId AS VARCHAR), count(*) FROM salary_range
            WHERE jobId NOT IN (SELECT id FROM job) GROUP BY jobId)
SELECT * FROM v WHERE n > 0""")
def audit_warehouse_q(spark, sf):
    """H9: all rules of the 14 warehouse tables, over a warehouse that breaks several of them."""
    from .. import schemas as SC
    from .jobs import conform, empty_warehouse
    no = F.lit(False)
    c, o, s, li = (table(spark, sf, t) for t in ("customer", "orders", "supplier", "lineitem"))
    key = F.col("c_custkey")
    company = c.select(F.concat(F.lit("c"), key.cast("string")).alias("id"),
                       F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
                       F.concat(F.lit("s"), F.floor(key / 2).cast("string")).alias("slug"), F.lit(0).alias("numJobs"),
                       no.alias("isFeatured"), no.alias("isRemoteFriendly"))
    office = s.filter(F.col("s_acctbal") >= 0).select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("location"))
    cust = F.col("o_custkey")
    job = o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("title"),
        F.when(F.col("o_orderstatus") != "O", F.concat(F.lit("u"), cust.cast("string"))).alias("url"),
        F.concat(F.lit("c"), F.when(F.col("o_orderstatus") == "P", -cust - 1).otherwise(cust).cast("string")).alias("companyId"),
        *[no.alias(f) for f in ("remote", "hybrid", "manager", "consultant", "contractor")],
        F.lit("COMPLETE").alias("dataCompleteness"))
    job_office = li.select(F.col("l_orderkey").alias("jobId"), F.col("l_suppkey").alias("officeId"))
    salary = o.select(F.col("o_orderkey").alias("id"), F.floor(F.col("o_orderkey") / 2).alias("jobId"))
    tables = {"company": company, "office": office, "job": job, "job_office": job_office, "salary_range": salary}
    wh = empty_warehouse(spark) | {name: conform(df, SC.WAREHOUSE[name]) for name, df in tables.items()}
    return audit_warehouse(wh, SC.REQUIRED, SC.UNIQUE, SC.FOREIGN)
