"""Sinks, versioned commits, streaming forms and vendor conformance."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglake import schemas as SC
from listinglake.sources import readers as R
from listinglake.sources import sinks as S
from listinglake.sources.literals import empty_frame, literal_frame
from listinglake.streaming import incremental as L


def test_versioned_commits_and_reset(spark, tmp_dir):
    base = f"{tmp_dir}/wh"
    df = literal_frame(spark, [("a", 1), ("b", 2)], "k string, v int")
    assert S.commit_version(df, base, "t") == 1
    assert S.commit_version(df.filter("v = 1"), base, "t") == 2
    assert S.list_versions(spark, base, "t") == [1, 2]
    assert S.read_current(spark, base, "t").count() == 1
    versions = S.reset_warehouse(spark, base, {"t": T.StructType.fromDDL("k string, v int"), "u": SC.MARKET})
    assert versions == {"t": 3, "u": 1}
    assert S.read_current(spark, base, "t").count() == 0
    assert S.read_current(spark, base, "missing") is None


def test_literals_are_jvm_side(spark):
    df = literal_frame(spark, [("x", 1)], "a string, b int")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and df.collect()[0].a == "x"
    assert empty_frame(spark, SC.JOB).count() == 0


def test_status_routing_and_skip_log(spark, tmp_dir):
    df = literal_frame(spark, [(1, " Active "), (2, "ACQUIRED"), (3, "inactive"), (4, "Closed"), (5, None)],
                       "id int, status string")
    log = S.write_by_status(df, f"{tmp_dir}/out")
    back = spark.read.json(f"{tmp_dir}/out")
    assert sorted((r.id, r.status_bucket) for r in back.collect()) == [
        (1, "active"), (2, "acquired"), (3, "inactive"), (4, "unknown"), (5, "unknown")]
    assert sorted((r.id, r.reason) for r in log.collect()) == [(4, "Unknown status: closed"), (5, "Unknown status: unknown")]


def test_csv_union_header_sorted(spark, tmp_dir):
    a = literal_frame(spark, [(1, "x")], "id int, name string")
    b = literal_frame(spark, [(2, "FR")], "id int, country string")
    from listinglake.operators.sets import union_all_sources
    S.write_csv_union(union_all_sources([a, b]), f"{tmp_dir}/csv")
    header = spark.read.text(f"{tmp_dir}/csv").filter(F.col("value").startswith("country")).first().value
    assert header == "country,id,name"


def test_wrapped_json_sink_roundtrip(spark, tmp_dir):
    df = spark.range(0, 25).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    S.write_json_wrapped(df.withColumn("fk", F.floor(F.col("k") / 10)), f"{tmp_dir}/docs", "fk", wrapper="items", order=["k"])
    rows, errors = R.read_wrapped_json(spark, f"{tmp_dir}/docs", "items",
                                       T.StructType.fromDDL("k long, name string"), glob="*.txt", recursive=True)
    got = sorted((r.k, r.pos) for r in rows.collect())
    assert got[:3] == [(0, 1), (1, 2), (2, 3)] and got[-1] == (24, 5) and errors.count() == 0


def _writers(root):
    """Numbers of the tasks that wrote the text files below ``root``."""
    return {f.split("-")[1] for _, _, files in os.walk(root) for f in files if f.startswith("part-") and f.endswith(".txt")}


def test_a_file_per_key_is_written_by_several_tasks(spark, tmp_dir):
    df = spark.range(0, 200).select(F.col("id").alias("k"), F.floor(F.col("id") / 5).alias("fk"))
    S.write_json_wrapped(df, f"{tmp_dir}/docs", "fk", order=["k"])
    assert len(os.listdir(f"{tmp_dir}/docs")) >= 40 and len(_writers(f"{tmp_dir}/docs")) > 1


def test_entity_dir_writes_in_several_tasks_and_opens_a_file_once(spark, tmp_dir):
    from listinglake.plans import catalog
    from listinglake.session import checkpoint_dir
    rows = [(k, f"S{k}", k % 5, -1.0 if k % 10 == 0 else 1.0) for k in range(40)] + [(7, "S7", 2, 1.0)]
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double") \
        .write.parquet(f"{tmp_dir}/supplier.parquet")
    scratch = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch)) if os.path.exists(scratch) else set()
    out = catalog.QUERIES["entity_dir"](spark, tmp_dir)
    landed = [d for d in set(os.listdir(scratch)) - before if d.startswith("entities-")]
    assert len(landed) == 1 and len(_writers(f"{scratch}/{landed[0]}")) > 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "Scan text" not in plan  # both frames read the stored texts
    got = sorted((r.slug, r.s_suppkey, r.s_name, r.error) for r in out.collect())
    assert got == sorted((f"sup-{k}", None, None, "unreadable JSON") if k % 10 == 0 else (f"sup-{k}", k, f"S{k}", None)
                         for k, *_ in rows)


def test_vendor_conformance(spark):
    ms = spark.createDataFrame(
        [({"result": {"jobs": [{"jobId": "7", "title": "SWE", "postingDate": "2024-01-01",
                                "properties": {"description": "<p>Build</p>", "primaryLocation": "Redmond"}}]}},)],
        "operationResult struct<result: struct<jobs: array<struct<jobId: string, title: string, postingDate: string,"
        " properties: struct<description: string, primaryLocation: string>>>>>")
    r = R.conform_vendor_postings(ms, "microsoft").collect()[0]
    assert (r.id, r.desc, r.company, r.location) == ("7", "Build", "microsoft", "Redmond")
    assert r.url == "https://jobs.careers.microsoft.com/global/en/job/7"
    g = spark.createDataFrame([(json.dumps([json.dumps(["g1", "Eng", None, json.dumps([None, "<b>Desc</b>"]), None, None,
                                                        None, None, "Zurich"])]),)], "value string")
    r = R.conform_vendor_postings(g, "google", as_of="2024-03-31").collect()[0]
    assert (r.id, r.title, r.desc, r.location, r.date) == ("g1", "Eng", "Desc", "Zurich", "2024-03-31")


def test_stream_insert_ignore_and_upsert_replay(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    schema = T.StructType.fromDDL("id long, ts timestamp, v string")
    batch1 = spark.createDataFrame([(1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 00:00:01", "b"),
                                    (1, "2024-01-01 00:00:02", "a2")], "id long, ts string, v string") \
        .withColumn("ts", F.to_timestamp("ts"))
    batch1.coalesce(1).write.parquet(f"{land}/p1")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(land)
    out = f"{tmp_dir}/dedup"
    L.run_available_now(L.stream_insert_ignore(stream, ["id"], "ts", "1 day").writeStream.format("parquet")
                        .option("path", out), f"{tmp_dir}/ck1")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]
    base = f"{tmp_dir}/wh"
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(land)
    L.run_available_now(reader.writeStream.foreachBatch(L.upsert_writer(base, "t", ["id"], "ts")), f"{tmp_dir}/ck2")
    got = {r.id: r.v for r in S.read_current(spark, base, "t").collect()}
    assert got == {1: "a2", 2: "b"}
    # a replayed batch id is skipped (its marker is already committed)
    L.upsert_writer(base, "t", ["id"], "ts")(batch1.limit(1), 0)
    assert S.list_versions(spark, base, "t") == [1] and S.current_version(spark, base, "t") == 1
    fs, marker = S._fs(spark, f"{base}/t/_batches/stream/0")
    assert fs.exists(marker)
    # versions committed by someone else do not hide a new batch
    other = f"{tmp_dir}/wh2"
    S.commit_version(batch1.limit(0), other, "t")
    L.upsert_writer(other, "t", ["id"], "ts")(batch1, 0)
    assert S.list_versions(spark, other, "t") == [1, 2]
    batch2 = spark.createDataFrame([(2, "2023-01-01 00:00:00", "old")], "id long, ts string, v string") \
        .withColumn("ts", F.to_timestamp("ts"))
    batch2.coalesce(1).write.parquet(f"{land}/p2")
    L.run_available_now(reader.writeStream.foreachBatch(L.upsert_writer(base, "t", ["id"], "ts")), f"{tmp_dir}/ck2")
    got = {r.id: r.v for r in S.read_current(spark, base, "t").collect()}
    assert got == {1: "a2", 2: "b"}  # an older ordinal never overwrites


def test_bucketed_commit_avoids_target_shuffle(spark, tmp_dir):
    from listinglake.operators.merge import upsert
    base = f"{tmp_dir}/wh"
    target = spark.range(0, 2000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("slug"),
                                         F.col("id").alias("v"))
    v = S.commit_bucketed(target, base, "company", ["slug"], 8)
    assert v == 1 and S.list_versions(spark, base, "company") == [1]
    spark.sql(f"DROP TABLE IF EXISTS {S._table_name('company', 1, base)}")  # a new session knows nothing of it
    t = S.read_bucketed(spark, base, "company")  # re-registered from the recorded spec
    batch = spark.range(1990, 2010).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("slug"),
                                           (F.col("id") * 10).alias("v"))
    out = upsert(t, batch, "slug", ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # only the batch moves
    assert out.count() == 2010 and out.filter("slug = 's1995'").first().v == 19950


def test_commit_goes_on_after_a_crashed_one(spark, tmp_dir):
    import os
    from listinglake.sources import sinks as K
    df = spark.range(3)
    assert K.commit_version(df, tmp_dir, "t") == 1
    os.makedirs(f"{tmp_dir}/t/v=2")  # a commit that died half-way
    assert K.commit_version(spark.range(5), tmp_dir, "t") == 3
    assert K.read_current(spark, tmp_dir, "t").count() == 5
