"""Scalar enrichment queries (I1–I13, I15–I20, I25) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import jsonish as JS
from ..functions import parse as P
from ..functions import text as TX
from .catalog import query, table
from .bindings import founders

_FOUNDER_ID_SQL = """
WITH f AS (SELECT p_partkey AS id, p_name AS name,
                  CASE WHEN p_size <= 10 THEN NULL WHEN p_size <= 15 THEN ''
                       ELSE 'linkedin.com/in/' || p_brand || '-' || CAST(p_size AS VARCHAR) END AS linkedin,
                  CASE WHEN p_size > 40 THEN NULL ELSE '@' || p_type || CAST(p_size AS VARCHAR) END AS twitter,
                  CASE WHEN p_retailprice > 1500 THEN 'bio ' || CAST(p_partkey AS VARCHAR) || ' ' || p_name || ' ' || p_type || ' ' || p_brand END AS bio
           FROM part)
SELECT id, sha256(lower(coalesce(name, '') || '::' || coalesce(linkedin, '') || '::' || coalesce(twitter, '') || '::'
                        || substring(coalesce(bio, ''), 1, 50))) AS founder_id FROM f"""


@query("founder_ids", _FOUNDER_ID_SQL)
def founder_ids(spark, sf):
    f = founders(spark, sf).drop("bio").join(
        table(spark, sf, "part").select(
            F.col("p_partkey").alias("id"),
            F.when(F.col("p_retailprice") > 1500,
                   F.concat_ws(" ", F.lit("bio"), F.col("p_partkey").cast("string"), "p_name", "p_type", "p_brand"))
             .alias("bio")), "id")
    return f.select("id", TX.founder_id("name", "linkedin", "twitter", "bio").alias("founder_id"))


_TITLE_SQL = """CASE WHEN p_size <= 4 THEN 'Junior Senior Dev' WHEN p_size <= 8 THEN 'Staff Engineer'
 WHEN p_size <= 12 THEN 'VP of ' || p_name WHEN p_size <= 16 THEN 'Engineering Manager' WHEN p_size <= 20 THEN ''
 WHEN p_size <= 24 THEN 'Head Chef' WHEN p_size <= 28 THEN 'Principal ' || p_type WHEN p_size <= 32 THEN 'Entry level'
 WHEN p_size <= 36 THEN 'Team Lead' WHEN p_size <= 40 THEN NULL ELSE p_name END"""
_LOCATION_SQL = "CASE p_type WHEN 'ECONOMY' THEN 'Remote - US' WHEN 'SMALL' THEN 'New York' ELSE NULL END"
_TYPE_SQL = "CASE WHEN p_size > 30 THEN 'Contract Role' WHEN p_size > 20 THEN 'Full Time' ELSE NULL END"
_EXP_SQL = """CASE WHEN p_size <= 10 THEN CAST(p_size AS VARCHAR) || '+ years' WHEN p_size <= 20 THEN '1-' || CAST(p_size AS VARCHAR) || ' years'
 WHEN p_size <= 30 THEN CAST(p_size AS VARCHAR) || ' Years' WHEN p_size <= 40 THEN 'Any' ELSE NULL END"""


def _sql(s: str) -> str:
    return s.replace("VARCHAR", "STRING")


@query("enrich_titles", f"""
WITH j AS (SELECT p_partkey, {_TITLE_SQL} AS title, {_LOCATION_SQL} AS location, {_TYPE_SQL} AS type, {_EXP_SQL} AS exp FROM part)
SELECT p_partkey,
  CASE WHEN title IS NULL OR title = '' THEN NULL
       WHEN lower(title) LIKE '%junior%' THEN 'JUNIOR' WHEN lower(title) LIKE '%entry%' THEN 'ENTRY'
       WHEN lower(title) LIKE '%senior%' THEN 'SENIOR' WHEN lower(title) LIKE '%lead%' THEN 'LEAD'
       WHEN lower(title) LIKE '%staff%' THEN 'SENIOR' WHEN lower(title) LIKE '%principal%' THEN 'LEAD'
       WHEN lower(title) LIKE '%director%' THEN 'EXECUTIVE' WHEN lower(title) LIKE '%vp%' THEN 'EXECUTIVE'
       WHEN lower(title) LIKE '%head%' THEN 'EXECUTIVE' ELSE 'MID' END AS seniority,
  coalesce(lower(location) LIKE '%remote%', false) AS remote,
  coalesce(lower(title) LIKE '%manager%', false) AS manager,
  coalesce(lower(type) LIKE '%contract%', false) AS contractor,
  regexp_replace(lower(CASE WHEN type IS NULL OR type = '' THEN 'Unknown' ELSE type END), '\\s+', '', 'g') AS job_type,
  TRY_CAST(nullif(regexp_extract(exp, '(\\d+)\\+?\\s*years?', 1), '') AS INTEGER) AS min_years
FROM j""")
def enrich_titles(spark, sf):
    j = table(spark, sf, "part").select("p_partkey", F.expr(_TITLE_SQL).alias("title"),
                                        F.expr(_LOCATION_SQL).alias("location"), F.expr(_TYPE_SQL).alias("type"),
                                        F.expr(_sql(_EXP_SQL)).alias("exp"))
    flags = P.job_flags("location", "title", "type")
    return j.select("p_partkey", P.seniority_label("title").alias("seniority"), flags["remote"].alias("remote"),
                    flags["manager"].alias("manager"), flags["contractor"].alias("contractor"),
                    F.map_keys(P.flag_map("type", default="Unknown"))[0].alias("job_type"),
                    P.parse_years_exp("exp").alias("min_years"))


_SALARY_TEXT_SQL = """CASE WHEN p_size <= 10 THEN '$' || CAST(p_size * 10 AS VARCHAR) || 'K - $' || CAST(p_size * 10 + 20 AS VARCHAR) || 'K'
 WHEN p_size <= 20 THEN '€' || CAST(p_size AS VARCHAR) || '.5M'
 WHEN p_size <= 30 THEN '£' || CAST(p_size AS VARCHAR) || ',000 - £' || CAST(p_size + 10 AS VARCHAR) || ',000'
 WHEN p_size <= 35 THEN CAST(p_size * 1000 AS VARCHAR) WHEN p_size <= 40 THEN 'negotiable' WHEN p_size <= 45 THEN ''
 ELSE '¥' || CAST(p_size AS VARCHAR) || ' per month' END"""


@query("enrich_salary", f"""
WITH s AS (SELECT p_partkey, {_SALARY_TEXT_SQL} AS txt FROM part),
n AS (SELECT p_partkey, txt, regexp_extract_all(txt, '\\d+(\\.\\d+)?') AS nums,
             CASE WHEN txt LIKE '%K%' OR txt LIKE '%k%' THEN 1000.0
                  WHEN txt LIKE '%M%' OR txt LIKE '%m%' THEN 1000000.0 ELSE 1.0 END AS mult FROM s),
r AS (SELECT p_partkey, trim(txt) <> '' AND len(nums) > 0 AS present,
             CAST(nums[1] AS DOUBLE) * mult AS mn, CAST(coalesce(nums[2], nums[1]) AS DOUBLE) * mult AS mx,
             coalesce(nullif(regexp_extract(txt, '[$€£¥]', 0), ''), 'USD') AS cur FROM n)
SELECT p_partkey, CASE WHEN present THEN mn END AS min_value, CASE WHEN present THEN mx END AS max_value,
       CASE WHEN present THEN cur END AS currency, CASE WHEN present THEN 'yearly' END AS period FROM r""")
def enrich_salary(spark, sf):
    s = table(spark, sf, "part").select("p_partkey", F.expr(_sql(_SALARY_TEXT_SQL)).alias("txt"))
    r = P.parse_salary(F.col("txt"))
    return s.select("p_partkey", r["min_value"].alias("min_value"), r["max_value"].alias("max_value"),
                    r["currency"].alias("currency"), r["period"].alias("period"))


_REL_TEXT_SQL = """CASE WHEN p_size <= 8 THEN CAST(p_size AS VARCHAR) || ' months ago'
 WHEN p_size <= 12 THEN 'about ' || CAST(p_size - 8 AS VARCHAR) || ' year ago' WHEN p_size <= 16 THEN 'a day ago'
 WHEN p_size <= 20 THEN CAST(p_size AS VARCHAR) || ' hours ago' WHEN p_size <= 24 THEN '2 weeks ago'
 WHEN p_size <= 28 THEN 'Monday' WHEN p_size <= 32 THEN NULL WHEN p_size <= 36 THEN 'a month ago'
 ELSE CAST(p_size AS VARCHAR) || ' days ago' END"""
_AS_OFS = ["2024-03-31 10:30:00", "2024-02-29 08:00:00"]


def _rel_sql(as_of: str) -> str:
    a = f"TIMESTAMP '{as_of}'"
    months = (f"CAST(date_trunc('month', {a}) AS DATE) - to_months({{n}}) + to_days(day({a}) - 1) "
              f"+ ({a} - date_trunc('day', {a}))")
    return f"""strftime(CASE WHEN txt IS NULL OR txt = '' THEN {a}
      WHEN txt LIKE '%month%' THEN {months.format(n='n')}
      WHEN txt LIKE '%year%' THEN {months.format(n='n * 12')}
      WHEN txt LIKE '%day%' THEN {a} - to_days(n)
      WHEN txt LIKE '%hour%' THEN {a} - to_hours(n) ELSE {a} END, '%Y-%m-%d %H:%M:%S')"""


@query("relative_dates", f"""
WITH t AS (SELECT p_partkey, {_REL_TEXT_SQL} AS txt FROM part),
n AS (SELECT p_partkey, txt, coalesce(TRY_CAST(nullif(regexp_extract(txt, '\\d+', 0), '') AS INTEGER), 1) AS n FROM t)
SELECT p_partkey, {_rel_sql(_AS_OFS[0])} AS ts_a, {_rel_sql(_AS_OFS[1])} AS ts_b FROM n""")
def relative_dates(spark, sf):
    t = table(spark, sf, "part").select("p_partkey", F.expr(_sql(_REL_TEXT_SQL)).alias("txt"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return t.select("p_partkey",
                    F.date_format(P.parse_relative_date("txt", _AS_OFS[0]), fmt).alias("ts_a"),
                    F.date_format(P.parse_relative_date("txt", _AS_OFS[1]), fmt).alias("ts_b"))


_SLUG_SQL = "substring(regexp_replace(regexp_replace(lower(@X@), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), 1, 100)"


@query("slugs", f"""
SELECT p_partkey, {_SLUG_SQL.replace('@X@', "'  ' || p_name || '!'")} AS slug,
       {_SLUG_SQL.replace('@X@', "p_brand || ' / ' || p_type || ' #' || CAST(p_size AS VARCHAR) || ' ' || repeat(p_name, 12)")} AS long_slug
FROM part""")
def slugs(spark, sf):
    p = table(spark, sf, "part")
    long_name = F.concat(F.col("p_brand"), F.lit(" / "), F.col("p_type"), F.lit(" #"), F.col("p_size").cast("string"),
                         F.lit(" "), F.repeat(F.col("p_name"), 12))
    return p.select("p_partkey", TX.slugify(F.concat(F.lit("  "), F.col("p_name"), F.lit("!"))).alias("slug"),
                    TX.slugify(long_name).alias("long_slug"))


_DOMAIN_SQL = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#@]*)', 1)), 'www\\.', '')"


@query("domains", f"SELECT page_id, nullif({_DOMAIN_SQL}, '') AS domain FROM pages")
def domains(spark, sf):
    return table(spark, sf, "pages").select("page_id", TX.extract_domain("url").alias("domain"))


@query("urls", """
WITH p AS (SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]+(/.*)$', 1) AS path, url FROM pages)
SELECT page_id,
       CASE WHEN path IS NOT NULL AND path <> '' THEN 'https://www.example.com' || path END AS abs_always,
       CASE WHEN path LIKE '/%' THEN 'https://www.example.com' || path ELSE path END AS abs_relative,
       CASE WHEN url LIKE '/%' THEN 'https://www.example.com' || url ELSE url END AS abs_kept
FROM p""")
def urls(spark, sf):
    p = table(spark, sf, "pages").select(
        "page_id", "url", F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+(/.*)$", 1).alias("path"))
    base = "https://www.example.com"
    return p.select("page_id", TX.absolutise("path", base).alias("abs_always"),
                    TX.absolutise("path", base, only_relative=True).alias("abs_relative"),
                    TX.absolutise("url", base, only_relative=True).alias("abs_kept"))


@query("ids_from_url", """
WITH u AS (SELECT page_id, url FROM pages
           UNION ALL SELECT page_id, 'https://www.metacareers.com/jobs/' || CAST(page_id * 7 AS VARCHAR) || '/' FROM pages)
SELECT page_id, url, CASE WHEN regexp_extract(url, '/jobs/(\\d+)/', 1) <> '' THEN regexp_extract(url, '/jobs/(\\d+)/', 1)
                          ELSE string_split(url, '/')[-1] END AS ext_id FROM u""")
def ids_from_url(spark, sf):
    p = table(spark, sf, "pages")
    u = p.select("page_id", "url").unionByName(p.select(
        "page_id", F.concat(F.lit("https://www.metacareers.com/jobs/"), (F.col("page_id") * 7).cast("string"),
                            F.lit("/")).alias("url")))
    return u.select("page_id", "url", TX.id_from_url("url").alias("ext_id"))


@query("locations_split", """
WITH s AS (SELECT n.n_nationkey, string_split(n.n_name || ', ' || r.r_name || ', , ' || n.n_name || ',', ',') AS parts
           FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
e AS (SELECT n_nationkey, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS part FROM s)
SELECT n_nationkey, CAST(pos AS INTEGER) AS pos, trim(part) AS location FROM e WHERE trim(part) <> ''""")
def locations_split(spark, sf):
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    s = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", TX.split_locations(F.concat_ws(", ", "n_name", "r_name", F.lit(""), F.concat("n_name", F.lit(","))))
        .alias("parts"))
    e = s.select("n_nationkey", F.posexplode("parts").alias("pos", "location"))
    return e.filter(F.col("location") != "").select("n_nationkey", (F.col("pos") + 1).cast("int").alias("pos"), "location")


@query("timestamps", """
SELECT o_orderkey,
       strftime(to_timestamp(epoch(o_orderdate)), '%Y-%m-%d %H:%M:%S') AS from_seconds,
       strftime(make_timestamp(CAST(epoch(o_orderdate) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS from_ms_text,
       strftime(CAST(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS from_iso,
       strftime(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS from_falsy
FROM orders""")
def timestamps(spark, sf):
    o = table(spark, sf, "orders")
    secs = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    iso = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss")
    falsy = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(iso)
    return o.select("o_orderkey",
                    F.date_format(P.epoch_seconds_to_ts(secs), fmt).alias("from_seconds"),
                    F.date_format(P.text_to_ts((secs * 1000).cast("string")), fmt).alias("from_ms_text"),
                    F.date_format(P.text_to_ts(iso), fmt).alias("from_iso"),
                    F.date_format(P.text_to_ts(falsy), fmt).alias("from_falsy"))


@query("strip_html", """
SELECT page_id, md5(regexp_replace(html, '<[^\\n]*?>', '', 'g')) AS text_md5,
       length(regexp_replace(html, '<[^\\n]*?>', '', 'g')) AS text_len FROM pages""")
def strip_html(spark, sf):
    t = TX.strip_html("html")
    return table(spark, sf, "pages").select("page_id", F.md5(t).alias("text_md5"), F.length(t).alias("text_len"))


def _k():
    return F.get_json_object("props", "$.k")


_ARRAY_SQL = """CASE event_type
  WHEN 'view' THEN '["loc' || k || '", {"label": "L' || k || '"}, {"value": "V' || k || '"}, "", {}]'
  WHEN 'click' THEN '[{"label": "", "value": "W' || k || '"}, {"label": "X' || k || '", "value": "Y"}]'
  WHEN 'error' THEN NULL
  WHEN 'signup' THEN 'not json'
  ELSE '["' || k || '"]' END"""


@query("json_unwrap", f"""
WITH e AS (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events),
a AS (SELECT event_id, {_ARRAY_SQL} AS arr FROM e),
l AS (SELECT event_id, coalesce(CASE WHEN json_valid(arr) THEN json_transform(arr, '["JSON"]') END, []) AS elems FROM a)
SELECT event_id, len(elems) AS n_elems,
       array_to_string(list_filter(list_transform(elems, lambda x: CASE WHEN json_type(x) = 'VARCHAR' THEN x ->> '$'
              WHEN json_type(x) = 'OBJECT' THEN coalesce(nullif(x ->> 'label', ''), nullif(x ->> 'value', '')) END),
              lambda y: y IS NOT NULL AND y <> ''), ',') AS labels
FROM l""")
def json_unwrap(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", _k().alias("k"))
    a = e.select("event_id", JS.json_array_to_strings(F.expr(_sql(_ARRAY_SQL))).alias("elems"))
    return a.select("event_id", F.size("elems").alias("n_elems"),
                    F.array_join(JS.unwrap_labels("elems"), ",").alias("labels"))


@query("link_merge", """
WITH e AS (SELECT event_id, user_id, json_extract_string(props, '$.k') AS k, event_type FROM events),
m AS (SELECT event_id,
        map_concat(map(['linkedin', 'website', 'github'], ['li/' || k, 'w/' || CAST(user_id AS VARCHAR), 'gh/' || k]),
                   CASE WHEN event_type IN ('view', 'click') THEN map(['website', 'facebook'], ['new/' || k, ''])
                        ELSE map(['twitter'], ['tw/' || k]) END) AS merged FROM e)
SELECT event_id,
       array_to_string(list_sort(list_transform(map_entries(merged), lambda x: x.key || '=' || x.value)), ';') AS merged,
       nullif(array_to_string(list_sort(list_transform(list_filter(map_entries(merged),
              lambda x: x.key IN ('linkedin', 'twitter', 'facebook', 'website') AND x.value IS NOT NULL AND x.value <> ''),
              lambda x: x.key || '=' || x.value)), ';'), '') AS picked
FROM m""")
def link_merge(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", _k().alias("k"))
    left = F.create_map(F.lit("linkedin"), F.concat(F.lit("li/"), "k"),
                        F.lit("website"), F.concat(F.lit("w/"), F.col("user_id").cast("string")),
                        F.lit("github"), F.concat(F.lit("gh/"), "k"))
    right = F.when(F.col("event_type").isin("view", "click"),
                   F.create_map(F.lit("website"), F.concat(F.lit("new/"), "k"), F.lit("facebook"), F.lit(""))) \
        .otherwise(F.create_map(F.lit("twitter"), F.concat(F.lit("tw/"), "k")))
    merged = JS.merge_links(left, right)

    def as_text(m):
        return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda x: F.concat(x["key"], F.lit("="), x["value"]))), ";")
    picked = JS.pick_links(merged)
    return e.select("event_id", as_text(merged).alias("merged"), F.when(picked.isNotNull(), as_text(picked)).alias("picked"))


@query("structs", f"""
WITH e AS (SELECT event_id, event_type, user_id, json_extract_string(props, '$.k') AS k FROM events),
c AS (SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE 'https://cdn.example.com/' || k || '.png' END AS thumb,
             CASE WHEN event_type = 'error' THEN NULL ELSE 'https://www.co' || CAST(user_id AS VARCHAR) || '.example.com/about' END AS website,
             'Company ' || CAST(user_id AS VARCHAR) AS name FROM e)
SELECT event_id,
       CASE WHEN thumb IS NOT NULL AND thumb <> '' THEN to_json({{'url': thumb}}) END AS logos,
       CASE WHEN website IS NOT NULL AND website <> '' THEN to_json({{'url': website, 'label': name}}) END AS website_json,
       to_json(CASE WHEN nullif({_DOMAIN_SQL.replace('url', 'website')}, '') IS NOT NULL
                    THEN [nullif({_DOMAIN_SQL.replace('url', 'website')}, '')] ELSE [] END) AS email_domains
FROM c""")
def structs(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "user_id", _k().alias("k"))
    c = e.select("event_id",
                 F.when(F.col("event_type") == "view", F.lit(""))
                  .otherwise(F.concat(F.lit("https://cdn.example.com/"), "k", F.lit(".png"))).alias("thumb"),
                 F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("https://www.co"), F.col("user_id").cast("string"),
                                      F.lit(".example.com/about"))).alias("website"),
                 F.concat(F.lit("Company "), F.col("user_id").cast("string")).alias("name"))
    return c.select("event_id", F.to_json(JS.build_logos("thumb")).alias("logos"),
                    F.to_json(JS.build_website("website", "name")).alias("website_json"),
                    F.to_json(JS.email_domains(TX.extract_domain("website"))).alias("email_domains"))


@query("json_text", """
WITH e AS (SELECT event_id, event_type, value, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id,
       CASE WHEN event_type = 'view' THEN NULL ELSE 'k' || k END AS as_string,
       to_json(['a' || k, event_type]) AS as_array,
       CASE WHEN value = 0 OR value IS NULL THEN NULL ELSE CAST(value AS VARCHAR) END AS as_number
FROM e""")
def json_text(spark, sf):
    from pyspark.sql import types as T
    e = table(spark, sf, "events").select("event_id", "event_type", "value", _k().alias("k"))
    s = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.concat(F.lit("k"), "k"))
    arr = F.array(F.concat(F.lit("a"), "k"), F.col("event_type"))
    return e.select("event_id", JS.json_text(s).alias("as_string"),
                    JS.json_text(arr, T.ArrayType(T.StringType())).alias("as_array"),
                    JS.json_text(F.col("value"), T.DoubleType()).alias("as_number"))
