"""Edge rows for the scalar functions (FIXTURES §2)."""

import datetime as dt
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglake.functions import core, html, jsonish, parse, rules, text


def one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("c", dtype)]))


def test_truthiness_by_type(spark):
    s = one_col(spark, [None, "", "0", " ", "x"], T.StringType())
    assert [r[0] for r in s.select(core.truthy("c")).collect()] == [False, False, True, True, True]
    d = one_col(spark, [None, 0.0, float("nan"), 1.5], T.DoubleType())
    assert [r[0] for r in d.select(core.truthy("c", T.DoubleType())).collect()] == [False, False, False, True]
    i = one_col(spark, [None, 0, 3], T.IntegerType())
    assert [r[0] for r in i.select(core.truthy("c", T.IntegerType())).collect()] == [False, False, True]
    b = one_col(spark, [None, False, True], T.BooleanType())
    assert [r[0] for r in b.select(core.to_flag("c", T.BooleanType())).collect()] == [False, False, True]
    a = one_col(spark, [None, [], ["x"]], T.ArrayType(T.StringType()))
    assert [r[0] for r in a.select(core.truthy("c", a.schema["c"].dataType)).collect()] == [False, True, True]


def test_or_default_keeps_only_truthy(spark):
    s = one_col(spark, [None, "", "a"], T.StringType())
    assert [r[0] for r in s.select(core.or_default("c", "d")).collect()] == ["d", "d", "a"]


def test_slugify(spark):
    s = one_col(spark, ["  Hello, World!  ", "a" * 150, "--x--", None], T.StringType())
    out = [r[0] for r in s.select(text.slugify("c")).collect()]
    assert out[0] == "hello-world"
    assert out[1] == "a" * 100
    assert out[2] == "x"
    assert out[3] is None
    fallback = s.select(text.slugify("c", trim_dashes=False, max_len=None)).collect()[0][0]
    assert fallback == "-hello-world-"


def test_extract_domain(spark):
    s = one_col(spark, ["https://www.a.com/x", "http://a.com:8080", "not a url", None, "https://WWW.Upper.COM/p"],
                T.StringType())
    assert [r[0] for r in s.select(text.extract_domain("c")).collect()] == ["a.com", "a.com", None, None, "upper.com"]


def test_relative_dates(spark):
    rows = ["3 months ago", "about 1 year ago", "a day ago", "5 hours ago", "2 weeks ago", "Monday", None]
    s = one_col(spark, rows, T.StringType())
    fmt = "yyyy-MM-dd HH:mm:ss"
    a = [r[0] for r in s.select(F.date_format(parse.parse_relative_date("c", "2024-03-31 00:00:00"), fmt)).collect()]
    assert a == ["2023-12-31 00:00:00", "2023-03-31 00:00:00", "2024-03-30 00:00:00", "2024-03-30 19:00:00",
                 "2024-03-31 00:00:00", "2024-03-30 00:00:00", "2024-03-31 00:00:00"]
    one_month = one_col(spark, ["1 month ago", "1 year ago"], T.StringType())
    b = [r[0] for r in one_month.select(F.date_format(parse.parse_relative_date("c", "2024-03-31 00:00:00"), fmt)).collect()]
    assert b[0] == "2024-03-02 00:00:00"  # Feb 31 overflows into March
    c = [r[0] for r in one_month.select(F.date_format(parse.parse_relative_date("c", "2024-02-29 00:00:00"), fmt)).collect()]
    assert c[1] == "2023-03-01 00:00:00"  # Feb 29 of a non-leap year overflows


def test_seniority(spark):
    s = one_col(spark, ["Junior Senior Dev", "Staff Engineer", "VP", "Plain Dev", ""], T.StringType())
    assert [r[0] for r in s.select(parse.seniority_label("c")).collect()] == ["JUNIOR", "SENIOR", "EXECUTIVE", "MID", None]
    m = s.select(parse.seniority_map("c")).collect()
    assert m[0][0] == {"JUNIOR": True} and m[4][0] == {}


def test_years_exp(spark):
    s = one_col(spark, ["3+ years", "1-3 years", "6 Years", "Any", None], T.StringType())
    assert [r[0] for r in s.select(parse.parse_years_exp("c")).collect()] == [3, 3, None, None, None]


def test_salary(spark):
    s = one_col(spark, ["$120K - $150K", "€1.5M", "£50,000 - £60,000", "100", "negotiable", ""], T.StringType())
    out = [r[0] for r in s.select(parse.parse_salary("c")).collect()]
    assert (out[0].min_value, out[0].max_value, out[0].currency) == (120000.0, 150000.0, "$")
    assert (out[1].min_value, out[1].max_value, out[1].currency) == (1500000.0, 1500000.0, "€")
    assert (out[2].min_value, out[2].max_value) == (50.0, 0.0)  # kept quirk
    assert (out[3].min_value, out[3].currency, out[3].period) == (100.0, "USD", "yearly")
    assert out[4] is None and out[5] is None
    loose = s.select(parse.parse_salary("c", strict=False)).collect()[2][0]
    assert (loose.min_value, loose.max_value) == (50000.0, 60000.0)


def test_split_locations(spark):
    s = one_col(spark, ["San Francisco, CA, USA", "Berlin,"], T.StringType())
    out = [r[0] for r in s.select(text.split_locations("c")).collect()]
    assert out == [["San Francisco", "CA", "USA"], ["Berlin", ""]]


def test_strip_html(spark):
    s = one_col(spark, ["<b>x</b>", "a<br\n>b", "1 < 2 <i>y</i>", "plain", None], T.StringType())
    assert [r[0] for r in s.select(text.strip_html("c")).collect()] == ["x", "a<br\n>b", "1 y", "plain", None]


def test_unwrap_label(spark):
    s = one_col(spark, ['"s"', "plain", '{"label":"L"}', '{"value":"V"}', '{"label":"L","value":"V"}', "", "{}"],
                T.StringType())
    out = [r[0] for r in s.select(jsonish.unwrap_label("c")).collect()]
    assert out == ['"s"', "plain", "L", "V", "L", None, None]
    arr = spark.createDataFrame([('["a", {"label": "b"}, {"value": "c"}, "", {}]',)], "j string")
    assert arr.select(jsonish.unwrap_labels(jsonish.json_array_to_strings("j"))).collect()[0][0] == ["a", "b", "c"]


def test_merge_and_pick_links(spark):
    df = spark.createDataFrame([({"linkedin": "l1", "website": "w1", "github": "g"}, {"website": "w2", "twitter": ""})],
                               "a map<string,string>, b map<string,string>")
    merged = df.select(jsonish.merge_links("a", "b").alias("m"))
    assert merged.collect()[0][0] == {"linkedin": "l1", "website": "w2", "github": "g", "twitter": ""}
    picked = merged.select(jsonish.pick_links("m")).collect()[0][0]
    assert picked == {"linkedin": "l1", "website": "w2"}


def test_social_links_last_and_first(spark):
    page = ('<a href="https://linkedin.com/a">1</a><a href="https://x.example.com">w</a>'
            '<a href="https://linkedin.com/b">2</a><a href="https://y.example.com">w2</a><a href=\'/rel\'>r</a>')
    df = spark.createDataFrame([(page,)], "html string")
    m = df.select(html.social_links("html")).collect()[0][0]
    assert m["linkedin"] == "https://linkedin.com/b"
    assert m["website"] == "https://x.example.com"


def test_data_page_payload(spark):
    page = '<div data-page="{&quot;props&quot;:{&quot;a&quot;:&quot;x &amp; y&quot;}}"></div>'
    df = spark.createDataFrame([(page,), ("<div></div>",)], "html string")
    out = [r[0] for r in df.select(html.data_page_attr("html")).collect()]
    assert out == ['{"props":{"a":"x & y"}}', None]


def test_founder_id_matches_hashlib(spark):
    import hashlib
    df = spark.createDataFrame([("Ann", "in/ann", None, "b" * 80)], "name string, li string, tw string, bio string")
    got = df.select(text.founder_id("name", "li", "tw", "bio")).collect()[0][0]
    want = hashlib.sha256(("Ann::in/ann::::" + "b" * 50).lower().encode()).hexdigest()
    assert got == want


def test_employer_rules_first_match(spark):
    df = one_col(spark, ["https://jobs.careers.microsoft.com/x", "https://careers.google.com/j", "https://x.org"],
                 T.StringType())
    assert [r[0] for r in df.select(rules.employer_from_url("c")).collect()] == ["Microsoft", "Google", None]
    names = one_col(spark, ["Apple Google JV", "", None, "Facebook"], T.StringType())
    assert [r[0] for r in names.select(rules.employer_category("c")).collect()] == ["apple", "unknown", "unknown", "meta"]


def test_timestamps(spark):
    df = spark.createDataFrame([("1700000000000",), ("2024-01-02T03:04:05",), ("",), ("garbage",)], "c string")
    out = [r[0] for r in df.select(F.date_format(parse.text_to_ts("c"), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert out == ["2023-11-14 22:13:20", "2024-01-02 03:04:05", None, None]


def test_hosts_and_overflow(spark):
    from pyspark.sql import functions as F
    from listinglake.functions import parse, text
    urls = {"https://www.my_host.com/a|b c": "my_host.com", "http://münchen.de:80/x": "münchen.de", "https://u:p@h.io?q": "h.io", "no url": None, "http://": None}
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", text.extract_domain(F.col("u")).alias("d")).collect()
    assert {r.u: r.d for r in got} == urls
    old = spark.createDataFrame([("999999999 years ago",), ("2147483647 days ago",), ("999999999 months ago",), ("2 days ago",)], "s string")
    out = [r.d for r in old.select(parse.parse_relative_date(F.col("s"), "2024-03-31 00:00:00").cast("string").alias("d")).collect()]
    assert out[:3] == [None, None, None] and out[3].startswith("2024-03-29")


def test_anchor_markup(spark):
    from listinglake.functions import html as HT
    page = ("<p data-x=1><a data-href=\"/x\" class=b href=\"/jobs/2?a=1&amp;b=2\"><b>Dev</b> &amp; Ops</a>"
            "<A HREF='/jobs/3'>PM</A><a href=\"/jobs/it's\">It</a><div id=a data-page='{\"k\": 1}'>")
    row = spark.createDataFrame([(page,)], "h string").select(
        HT.job_links("h", "https://e.com").alias("jobs"), HT.hrefs("h").alias("hrefs"), HT.data_page_attr("h").alias("page")).first()
    assert [(r.href, r.text) for r in row.jobs] == [("https://e.com/jobs/2?a=1&b=2", "Dev & Ops"), ("https://e.com/jobs/3", "PM"),
                                                    ("https://e.com/jobs/it's", "It")]
    assert row.hrefs == ["/jobs/2?a=1&b=2", "/jobs/3", "/jobs/it's"] and row.page == '{"k": 1}'
