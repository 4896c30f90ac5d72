"""Landed documents per line, landing keys, the merge over one key index, components on links, bucketed increments, rule matching
and character references."""

import glob
import html as stdlib_html
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglake import schemas as SC
from listinglake.functions import html as HT
from listinglake.functions import rules as RU
from listinglake.operators import identity as ID
from listinglake.operators import merge as H
from listinglake.operators.validate import audit_warehouse
from listinglake.plans import jobs as K
from listinglake.session import settings
from listinglake.sources import readers as R
from listinglake.sources import sinks as S
from listinglake.sources.staging import stage_portfolio
from listinglake.streaming import incremental as L

RECORD = T.StructType([T.StructField("a", T.LongType()), T.StructField("pad", T.StringType())])


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


# landed lines

def test_one_large_file_is_read_by_several_tasks_with_exact_line_numbers(spark, tmp_dir):
    lines = [json.dumps({"a": i, "pad": "x" * (i % 90)}) if i % 50 else "{broken" for i in range(1, 4001)]
    write(f"{tmp_dir}/in/big.jsonl", "\n".join(lines) + "\n")
    write(f"{tmp_dir}/in/small.jsonl", '\n[{"a": 1}, 7, {"a": 2}]\r\n{"jobs": [{"a": 3}]}\n{"jobs": 5}\n  \n{"a": 4}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(f"{tmp_dir}/in/big.jsonl").rdd.getNumPartitions() > 5
        rows, errors = R.read_json_lines(spark, f"{tmp_dir}/in", "jobs", RECORD)
        got = [(r.file_name, r.line, r.pos, r.a) for r in rows.collect()]
        bad = [(r.file_name, r.line, r.pos, r.reason, r.raw) for r in errors.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    big = sorted(x[1:] for x in got if x[0] == "big.jsonl")
    assert big == [(i, 1, i) for i in range(1, 4001) if i % 50]
    assert sorted(x[1] for x in bad if x[0] == "big.jsonl") == list(range(50, 4001, 50))
    assert sorted(x[1:] for x in got if x[0] == "small.jsonl") == [(2, 1, 1), (2, 3, 2), (3, 1, 3), (6, 1, 4)]
    assert sorted((x[1], x[2], x[3], x[4]) for x in bad if x[0] == "small.jsonl") == [
        (2, 2, "record is no JSON object", "7"), (4, None, "jobs is no array", '{"jobs": 5}')]


def test_documents_are_written_to_few_files(spark, tmp_dir):
    df = spark.range(3000).selectExpr("id % 3 AS f", "id DIV 10 AS doc", "id AS a")
    S.write_json_documents(df, f"{tmp_dir}/out", "doc", wrapper="jobs", order=["a"], folders=["f"], tasks=4)
    files = glob.glob(f"{tmp_dir}/out/f=*/*.txt")
    assert 3 <= len(files) <= 12
    names = [sorted(os.path.basename(x) for x in files if f"/f={k}/" in x) for k in range(3)]
    assert names[0] == names[1] == names[2]  # a task writes the same name into every folder
    rows, errors = R.read_json_lines(spark, f"{tmp_dir}/out", "jobs", RECORD, glob="*.txt", recursive=True)
    assert sorted(r.a for r in rows.collect()) == list(range(3000)) and errors.count() == 0
    S.write_json_documents(df.drop("f"), f"{tmp_dir}/flat", "doc", order=["a"], tasks=2)
    rows, _ = R.read_json_lines(spark, f"{tmp_dir}/flat", "jobs", RECORD, glob="*.txt")
    assert rows.count() == 3000 and len(glob.glob(f"{tmp_dir}/flat/*.txt")) <= 2


@pytest.mark.parametrize("mode", ["upsert", "insert"])
def test_two_sources_with_files_of_one_name(spark, tmp_dir, mode):
    """Each job keeps its own office and salary range, and jobs without a url are two, wherever the folder lies."""
    ids = []
    for place in ("x y+z%20", "other"):
        root = f"{tmp_dir}/{place}"
        for folder, title, city, pay in (("b1", "Eng", "Paris", "5000"), ("b2", "PM", "Rome", "4000")):
            write(f"{root}/{folder}/jobs.json", json.dumps([{"title": title, "companySlug": "acme", "companyDomain": "acme.com", "locations": [city],
                                                            "salary": {"minValue": pay}}]))
        write(f"{root}/c/companies.json", json.dumps([{"name": "Acme", "slug": "acme", "domain": "acme.com"}]))
        out = K.consolidate_portfolio(spark, root, [("c", "c", "C")], [("b1", "b1", None), ("b2", "b2", None)])
        keys = stage_portfolio(out["companies"], out["jobs"])["job"].select("job_key")
        assert sorted(r.job_key for r in keys.collect()) == ["b1:jobs.json:1", "b2:jobs.json:1"]
        wh, _ = K.load_portfolio(K.empty_warehouse(spark), out["companies"], out["jobs"], mode=mode)
        j = wh["job"].select(F.col("id").alias("jobId"), "title")
        offices = wh["job_office"].join(wh["office"].withColumnRenamed("id", "officeId"), "officeId").join(j, "jobId")
        assert sorted((r.title, r.location) for r in offices.collect()) == [("Eng", "Paris"), ("PM", "Rome")]
        assert sorted((r.title, r.minValue) for r in wh["salary_range"].join(j, "jobId").collect()) == [("Eng", 5000.0), ("PM", 4000.0)]
        ids.append(sorted(r.jobId for r in j.collect()))
    assert len(set(ids[0])) == 2 and ids[0] == ids[1]


# merge

def test_upsert_rows_without_a_key(spark):
    t = spark.createDataFrame([("a", 1, 1), (None, 2, 2)], "k string, v int, w int")
    s = spark.createDataFrame([("a", 7, 8, 1), ("b", 9, 9, 2), (None, 5, 6, 3), (None, 3, 4, 4)], "k string, v int, w int, o int")
    got = sorted((r.k or "", r.v, r.w) for r in H.upsert(t, s, "k", ["v"], ordinal="o").collect())
    assert got == [("", 2, 2), ("", 3, 4), ("", 5, 6), ("a", 7, 1), ("b", 9, 9)]


def brute_two_tier(target, staged):
    """The rules row by row."""
    last = {}
    for r in sorted(staged, key=lambda r: r["ordinal"]):
        if r["url"]:
            last[r["companyId"], r["url"]] = r
    rest = [*last.values(), *[r for r in staged if not r["url"]]]
    by_title = {}
    for r in sorted(rest, key=lambda r: r["ordinal"]):
        by_title[r["companyId"], r["title"]] = r
    hits, new = {}, []
    for r in sorted(by_title.values(), key=lambda r: r["ordinal"]):
        known = r["companyId"] is not None
        mid = min((t["id"] for t in target if known and r["url"] and (t["companyId"], t["url"]) == (r["companyId"], r["url"])), default=None)
        mid = mid or min((t["id"] for t in target if known and r["title"] is not None and (t["companyId"], t["title"]) == (r["companyId"], r["title"])), default=None)
        if mid:
            hits[mid] = r
        else:
            new.append(r)
    out = [(t["companyId"], *(hits[t["id"]][c] if t["id"] in hits else t[c] for c in ("url", "title")), t["id"]) for t in target]
    return sorted(map(str, out)), sorted(str((r["companyId"], r["url"], r["title"])) for r in new)


def test_two_tier_upsert_against_the_rules(spark):
    rnd = random.Random(4)
    for _ in range(4):
        target = [{"id": f"t{i:03}", "companyId": rnd.choice(["a", "b", None]), "url": rnd.choice(["", None, "u1", "u2", "u3"]),
                   "title": rnd.choice(["x", "y", "z", None])} for i in range(25)]
        staged = [{"companyId": rnd.choice(["a", "b", "c", None]), "url": rnd.choice(["", None, "u1", "u2", "u4"]),
                   "title": rnd.choice(["x", "y", "w", None]), "ordinal": i} for i in range(25)]
        t = spark.createDataFrame([tuple(r.values()) for r in target], "id string, companyId string, url string, title string")
        s = spark.createDataFrame([tuple(r.values()) for r in staged], "companyId string, url string, title string, ordinal int")
        got = H.upsert_jobs(t, s, mode="two_tier", replace=["url", "title"]).collect()
        old, new = brute_two_tier(target, staged)
        assert sorted(str((r.companyId, r.url, r.title, r.id)) for r in got if r.id in {x["id"] for x in target}) == old
        assert sorted(str((r.companyId, r.url, r.title)) for r in got if r.id not in {x["id"] for x in target}) == new


@pytest.mark.parametrize("mode", ["two_tier", "title"])
def test_the_target_is_shuffled_twice(spark, tmp_dir, mode):
    """Once as narrow key rows (read again for other keys without another shuffle), once whole."""
    path = f"{tmp_dir}/target"
    spark.range(2000).selectExpr("cast(id AS string) AS id", "id % 50 AS companyId", "concat('u', id) AS url", "concat('t', id % 9) AS title",
                                 "id AS salary").write.parquet(path)
    staged = spark.range(300).selectExpr("id % 60 AS companyId", "concat('u', id * 3) AS url", "concat('t', id % 12) AS title", "id AS salary", "id AS ordinal")
    out = H.upsert_jobs(spark.read.parquet(path), staged, mode=mode)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = H.upsert_jobs(spark.read.parquet(path), staged, mode=mode)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # what is read of the target: the whole rows, and the narrow key rows
    wide = [x for x in plan.splitlines() if "FileScan" in x and "salary" in x]
    assert len(wide) == 1
    assert out.count() == 2000 + out.filter("length(id) = 64").count()


def test_a_long_path_needs_few_rounds(spark, monkeypatch):
    rounds = []
    real = ID.store
    monkeypatch.setattr(ID, "store", lambda df, name: rounds.append(name) or real(df, name))
    edges = spark.range(10_000).selectExpr("(id * 7919) % 10007 AS src", "((id + 1) * 7919) % 10007 AS dst")
    got = ID.edge_components(edges)
    assert got.select("component").distinct().count() == 1 and got.count() == 10_001
    assert len(rounds) <= 20  # a list per round; label spreading would need 10,000


def test_components_against_union_find(spark):
    rnd = random.Random(3)
    for n, m in ((50, 20), (60, 60), (40, 200)):
        links = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in links:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
        got = {r.id: r.component for r in ID.connected_components(spark.range(n), spark.createDataFrame(links, "src long, dst long")).collect()}
        assert got == {i: find(i) for i in range(n)}


# increments

def test_increments_leave_untouched_buckets_alone_and_replays_change_nothing(spark, tmp_dir):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("o", T.LongType()), T.StructField("v", T.StringType())])
    state = L.BucketedState(spark, tmp_dir, "t", schema, ["k"], "o", 8)

    def batch(keys, o):
        return spark.createDataFrame([(k, o, f"v{o}") for k in keys], schema)
    assert state.read().count() == 0
    state.upsert(batch(range(100), 1), "q", 0)
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{tmp_dir}/t/data/*/bucket=*/*.parquet")}
    used = {r.bucket: r.folder for r in state._manifest() if r.bucket is not None}
    assert len(used) == 8
    state.upsert(batch([5], 2), "q", 1)
    now = {r.bucket: r.folder for r in state._manifest() if r.bucket is not None}
    changed = [b for b in now if now[b] != used[b]]
    assert len(changed) == 1
    assert {f: os.path.getmtime(f) for f in files} == files  # nothing that was there is written again
    new = [f for f in glob.glob(f"{tmp_dir}/t/data/*/bucket=*/*.parquet") if f not in files]
    assert new and all(f"bucket={changed[0]}/" in f for f in new)
    got = {r.k: r.o for r in state.read().collect()}
    assert got[5] == 2 and len(got) == 100 and sum(got.values()) == 101
    for n in (0, 1):  # replays, one of them with other rows
        state.upsert(batch(range(200), 9), "q", n)
    assert {r.k: r.o for r in state.read().collect()} == got
    state.upsert(batch([5, 300], 0), "other query", 0)  # older than what is there
    got2 = {r.k: r.o for r in L.BucketedState(spark, tmp_dir, "t", schema, ["k"], "o", 8).read().collect()}
    assert got2 == got | {300: 0}
    # a write whose manifest never came is not seen
    batch([5], 50).write.partitionBy("k").parquet(f"{tmp_dir}/t/data/halfway")
    assert {r.k: r.o for r in state.read().collect()} == got2


# rules and markup

def test_first_rule_wins_also_where_needles_overlap(spark):
    rules = [("bc", "second letters"), (("abc", "xyz"), "whole"), ("z", "end")]
    texts = ["abc", "ABC", "xyz", "zz", "a", "", None, "zabc", "x-y-z"]
    want = ["second letters", "second letters", "whole", "end", None, None, None, "second letters", "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r.x for r in df.select("i", RU.first_contained("t", rules).alias("x")).orderBy("i").collect()] == want
    out = RU.with_first_contained(df, "x", "t", rules, when=F.col("i") != 0)
    assert out.columns == ["i", "t", "x"]
    assert [r.x for r in out.orderBy("i").collect()] == [None, *want[1:]]
    plan = out.filter("x IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1  # a filter on the result does not bring the matching back


def test_character_references_in_one_pass(spark):
    texts = ["&amp;quot;", "a &lt;b&gt; &#39;c&#x27; &quot;", "&eacute;&#233;&#xE9;&Eacute;", "&nosuch; & &; &#; &amp", "&#0;&#xD800;&#1114112;&#99999999999999999999;",
             "&#128512;&#x1F600;", "&apos;&hellip;&nbsp;", "", "plain", "&amp;&amp;amp;", None]
    got = [r.x for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", HT.decode_entities("t").alias("x")).orderBy("i").collect()]
    assert got[4] == "�" * 4 and got[3] == texts[3] and got[10] is None
    for i in (0, 1, 2, 5, 6, 7, 8, 9):
        assert got[i] == stdlib_html.unescape(texts[i]), texts[i]


def test_audit_tells_key_parts_apart(spark):
    wh = K.empty_warehouse(spark)
    wh["founder"] = K.conform(spark.createDataFrame([("1", "a|b", "c"), ("2", "a", "b|c"), ("3", "n", "l"), ("4", "n", "l"), ("5", "n", None), ("6", "n", None)],
                                                    "id string, name string, linkedin string"), SC.FOUNDER)
    wh["company_founder"] = K.conform(spark.createDataFrame([("x", "3"), ("x", "9"), ("x", "9"), (None, "3")], "companyId string, founderId string"), SC.COMPANY_FOUNDER)
    got = sorted(tuple(r) for r in audit_warehouse(wh, SC.REQUIRED, SC.UNIQUE, SC.FOREIGN).fillna("").collect())
    assert got == [("company_founder", "fk(companyId)", "x", 3), ("company_founder", "fk(founderId)", "9", 2), ("company_founder", "not_null(companyId)", "", 1),
                   ("company_founder", "unique(companyId,founderId)", "x|9", 2), ("founder", "unique(name,linkedin)", "n|l", 2)]


def test_audit_moves_key_columns_only(spark):
    """No row is blown up into an entry per rule: keys move as they are, without rule names and arrays of parts."""
    wh = K.empty_warehouse(spark)
    wh["job_office"] = K.conform(spark.range(4).selectExpr("id DIV 2 AS jobId", "5 AS officeId"), SC.JOB_OFFICE)
    found = audit_warehouse(wh, SC.REQUIRED, SC.UNIQUE, SC.FOREIGN)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("job_office", "fk(jobId)", "0", 2), ("job_office", "fk(jobId)", "1", 2), ("job_office", "fk(officeId)", "5", 4),
        ("job_office", "unique(jobId,officeId)", "0|5", 2), ("job_office", "unique(jobId,officeId)", "1|5", 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_compact" not in plan and "explode" not in plan and "array<string>" not in plan


def test_stored_tables_are_written_once(spark):
    """A load's stored tables are not written again for the next feed."""
    from listinglake.session import store
    at = store(spark.range(3), "once")
    assert K.materialize(at) is at and K.materialize_changed({"job": at}, {})["job"] is at
    assert K.materialize(at.filter("id > 0")).count() == 2


# what a load moves and leaves on disk

def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/**/shuffle_*.data", recursive=True)}


def test_stored_tables_leave_no_shuffle_files(spark, tmp_dir):
    before = shuffle_files(spark)
    rows = spark.range(2000).selectExpr("id", "id % 7 AS k", "id DIV 10 AS doc")
    kept = [K.materialize(rows.repartition(3, "k").distinct(), "t")]
    S.write_json_documents(rows, f"{tmp_dir}/docs", "doc", tasks=3)
    for _ in range(100):  # executors drop the files in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and kept[0].count() == 2000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Join")


@pytest.mark.parametrize("mode", ["upsert", "insert"])
def test_salaries_and_offices_come_with_their_job(spark, mode):
    """No join by a landing place, and one move by job for either table."""
    comps = spark.createDataFrame([{"name": f"C{i}", "slug": f"c{i}"} for i in range(9)], SC.PORTFOLIO_COMPANY)
    jobs = spark.createDataFrame([{"companySlug": f"c{i % 10}", "title": f"t{i % 40}", "url": f"u{i % 30}" if i % 3 else None, "locations": [f"P{i % 4}", "Rome"],
                                   "salary": {"minValue": str(i + 1)}} for i in range(200)], SC.PORTFOLIO_JOB)
    def landed(df):
        return df.coalesce(1).withColumn("file_name", F.lit("f")).withColumn("pos", F.monotonically_increasing_id().cast("int"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh, _ = K.load_portfolio(K.empty_warehouse(spark), landed(comps).withColumn("dataSource", F.lit("P")), landed(jobs), mode=mode)
        assert exchanges(wh["salary_range"].select("jobId", "minValue")) == (1, 0)
        assert exchanges(wh["job_office"])[1] == 1  # with the offices' ids alone
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    if mode == "upsert":
        best = {(i % 10, i % 40): i for i in range(200) if i % 10 < 9}
    else:
        best = {}
        for i in range(200):
            if i % 10 < 9:
                best.setdefault((i % 10, i % 30) if i % 3 else i, i)
    expected = sorted((f"c{i % 10}", f"t{i % 40}", i + 1.0, x) for i in best.values() for x in (f"P{i % 4}", "Rome"))
    j = wh["job"].select(F.col("id").alias("jobId"), "companyId", "title").join(wh["company"].select(F.col("id").alias("companyId"), "slug"), "companyId")
    off = wh["job_office"].join(wh["office"].select(F.col("id").alias("officeId"), "location"), "officeId")
    got = j.join(wh["salary_range"].select("jobId", "minValue"), "jobId").join(off, "jobId")
    assert sorted((r.slug, r.title, r.minValue, r.location) for r in got.collect()) == expected


def test_jobs_of_companies_that_share_an_id(spark):
    """Jobs are merged by company id, also where one id stands under two slugs."""
    wh = K.empty_warehouse(spark)
    wh["company"] = K.conform(spark.createDataFrame([("x", "a", "A"), ("x", "b", "B"), ("y", "c", "C")], "id string, slug string, name string"), SC.COMPANY)
    comps = spark.createDataFrame([{"name": s.upper(), "slug": s} for s in "abc"], SC.PORTFOLIO_COMPANY).withColumn("file_name", F.lit("f")).withColumn("pos", F.lit(1))
    jobs = spark.createDataFrame([{"companySlug": s, "title": "t", "url": "u", "salary": {"minValue": str(i + 1)}} for i, s in enumerate("abc")], SC.PORTFOLIO_JOB)
    jobs = jobs.withColumn("file_name", F.lit("f")).withColumn("pos", F.get_json_object(F.to_json("salary"), "$.minValue").cast("int"))
    for mode, pay in (("upsert", [("x", 2.0), ("y", 3.0)]), ("insert", [("x", 1.0), ("y", 3.0)])):
        out, _ = K.load_portfolio(wh, comps.withColumn("dataSource", F.lit("P")), jobs, mode=mode)
        got = out["job"].join(out["salary_range"].select(F.col("jobId").alias("id"), "minValue"), "id").collect()
        assert out["job"].count() == 2 and sorted((r.companyId, r.minValue) for r in got) == pay


def test_lines_do_not_move_to_be_numbered(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.jsonl", "\n".join(json.dumps({"a": i}) for i in range(500)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = R.read_lines(spark, f"{tmp_dir}/in")
        assert "SortMergeJoin" not in lines._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.line for r in lines.collect()) == list(range(1, 501))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_companys_jobs_are_still_split(spark):
    """The join with the companies splits a slug that holds most jobs, and the result is the same."""
    comps = spark.range(50).selectExpr("concat('s', id) AS slug", "concat('i', id) AS id")
    rows = spark.range(40000).selectExpr("if(id % 10 < 8, 's1', concat('s', id % 50)) AS companySlug", "concat('t', id DIV 2) AS title",
                                         "cast(null AS string) AS url", "'f' AS file_name", "cast(id AS int) AS pos")
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SC.PORTFOLIO_JOB.fields if f.name not in rows.columns])
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    plans = []

    def collapse(df, cols, order):
        out = K.D.last_wins(df, [*cols, "title"], order)
        with settings(spark, {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}):  # as the load runs it
            out.collect()
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    with settings(spark, conf):
        got = K._staged_jobs(rows.repartition(8, "title"), comps, collapse)
    assert "skew=true" in plans[0]
    want = {}
    for i in range(40000):
        want["s1" if i % 10 < 8 else f"s{i % 50}", f"t{i // 2}"] = i
    assert got.count() == len(want) and got.agg(F.sum("_ord.pos")).first()[0] == sum(want.values())


def test_state_query_joins_each_load_on_its_own(spark):
    """Both loads' rows are stored, so that the joins of one are gone when the other's run."""
    import __spark_entry__ as E
    plan = E.queries()["portfolio_two_sources_state"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
