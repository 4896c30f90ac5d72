"""Brute-force checks: column expressions against plain-Python statements of the same rules on
random inputs, and invariants of the dedupe / split operators under repartitioning."""

import calendar
import datetime as dt
import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglake.functions import parse as P
from listinglake.functions import text as TX
from listinglake.operators import dedupe as D
from listinglake.operators.split import split_halves

ALPHABET = "aZ09 -_.,/!é$€£¥Kkm+"


def rand_strings(n, seed, max_len=24, alphabet=ALPHABET):
    rng = random.Random(seed)
    return [None] + [""] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, max_len))) for _ in range(n)]


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def py_slug(s):
    if s is None:
        return None
    out = re.sub(r"[^a-z0-9]+", "-", s.lower())
    out = re.sub(r"^-|-$", "", out)
    return out[:100]


def test_slugify_matches_python(spark):
    vals = rand_strings(400, 1) + ["A" * 150, "--x--"]
    got = dict(frame(spark, vals).select("i", TX.slugify("s").alias("o")).collect())
    assert all(got[i] == py_slug(v) for i, v in enumerate(vals))


def py_salary(s):
    if s is None or s.strip() == "":
        return None
    nums = [m.group(0) for m in re.finditer(r"\d+(\.\d+)?", s)]
    if not nums:
        return None
    mult = 1000.0 if ("K" in s or "k" in s) else (1e6 if ("M" in s or "m" in s) else 1.0)
    vals = [float(x) * mult for x in nums]
    cur = re.search(r"[$€£¥]", s)
    return (vals[0], vals[1] if len(vals) > 1 else vals[0], cur.group(0) if cur else "USD")


def test_salary_matches_python(spark):
    vals = rand_strings(400, 2)
    got = {r.i: r.o for r in frame(spark, vals).select("i", P.parse_salary("s").alias("o")).collect()}
    for i, v in enumerate(vals):
        want = py_salary(v)
        o = got[i]
        assert (None if o is None else (o.min_value, o.max_value, o.currency)) == want, v


SEN = [("junior", "JUNIOR"), ("entry", "ENTRY"), ("senior", "SENIOR"), ("lead", "LEAD"), ("staff", "SENIOR"),
       ("principal", "LEAD"), ("director", "EXECUTIVE"), ("vp", "EXECUTIVE"), ("head", "EXECUTIVE")]


def py_seniority(t):
    if not t:
        return None
    low = t.lower()
    return next((lab for kw, lab in SEN if kw in low), "MID")


def test_seniority_and_years_match_python(spark):
    words = ["Junior", "entry", "Senior", "lead", "STAFF", "principal", "Director", "VP", "head", "dev", " ",
             "3", "+", "years", "year", "Years", "-", "1"]
    rng = random.Random(3)
    vals = [None, ""] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(400)]
    rows = frame(spark, vals).select("i", P.seniority_label("s").alias("a"), P.parse_years_exp("s").alias("b")).collect()
    got = {r.i: (r.a, r.b) for r in rows}
    for i, v in enumerate(vals):
        m = re.search(r"(\d+)\+?\s*years?", v or "")
        assert got[i] == (py_seniority(v), int(m.group(1)) if m else None), v


def months_back(ts, n):
    # calendar months with day overflow into the next month (31 Mar − 1 month → 2 Mar)
    y, m = divmod(ts.year * 12 + ts.month - 1 - n, 12)
    first = dt.datetime(y, m + 1, 1, ts.hour, ts.minute, ts.second)
    return first + dt.timedelta(days=ts.day - 1)


def py_relative(s, as_of):
    if not s:
        return as_of
    m = re.search(r"\d+", s)
    n = int(m.group(0)) if m else 1
    if "month" in s:
        return months_back(as_of, n)
    if "year" in s:
        return months_back(as_of, 12 * n)
    if "day" in s:
        return as_of - dt.timedelta(days=n)
    if "hour" in s:
        return as_of - dt.timedelta(hours=n)
    return as_of


def test_relative_dates_match_python(spark):
    rng = random.Random(4)
    units = ["month", "months", "year", "years", "day", "days", "hour", "hours", "week", "Monday"]
    vals = [None, ""] + [f"{rng.choice(['', 'about ', 'a '])}{rng.choice(['', str(rng.randint(1, 40))])} "
                         f"{rng.choice(units)} ago" for _ in range(300)]
    for as_of in (dt.datetime(2024, 3, 31, 10, 30), dt.datetime(2024, 2, 29, 8, 0), dt.datetime(2023, 12, 31, 0, 0)):
        col = F.date_format(P.parse_relative_date("s", as_of.strftime("%Y-%m-%d %H:%M:%S")), "yyyy-MM-dd HH:mm:ss")
        got = dict(frame(spark, vals).select("i", col.alias("o")).collect())
        for i, v in enumerate(vals):
            assert got[i] == py_relative(v, as_of).strftime("%Y-%m-%d %H:%M:%S"), (v, as_of)


def test_first_wins_is_partitioning_invariant(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "source", F.col("lang").alias("companyDomain"), F.md5("text").alias("title"))
    docs = docs.withColumn("rank", F.substring("source", 4, 3).cast("int"))
    a = D.first_wins(docs, D.job_key(), ["rank", "doc_id"]).select("doc_id").collect()
    b = D.first_wins(docs.repartition(7, "doc_id"), D.job_key(), ["rank", "doc_id"]).select("doc_id").collect()
    c = D.first_wins(docs.coalesce(1), D.job_key(), ["rank", "doc_id"]).select("doc_id").collect()
    assert sorted(a) == sorted(b) == sorted(c)
    s = D.dedupe_summary(docs, D.job_key()).collect()[0]
    log = D.duplicates_log(docs, D.job_key(), ["rank", "doc_id"], "source").count()
    assert s.unique + s.duplicates == s.processed and log == s.duplicates and len(a) == s.unique


def test_split_halves_reconcile(spark):
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").filter("c_mktsegment <> 'BUILDING'")
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = split_halves(c.select("c_custkey"), o.select("o_orderkey", "o_custkey"), ["c_custkey"], "c_custkey", "o_custkey")
    counts = {r.half: r["count"] for r in out.groupBy("half").count().collect()}
    assert sum(counts.values()) == o.count()  # A + B + orphans = total
