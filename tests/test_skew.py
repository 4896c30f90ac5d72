"""A third of the rows on one key: results stay whole and exact (no caps, no sampling)."""

from pyspark.sql import functions as F

from listinglake.operators import dedupe as D
from listinglake.operators import identity as ID
from listinglake.operators import joins as J
from listinglake.operators import merge as H
from listinglake.operators.positions import position_within

N = 30000


def hot(spark):
    return spark.range(N).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("key"),
        (F.col("id") % 7).cast("int").alias("src"))


def test_first_wins_and_log_with_hot_key(spark):
    df = hot(spark)
    winners = D.first_wins(df, "key", ["src", "id"])
    w = {r.key: r.id for r in winners.collect()}
    assert w["HOT"] == 0 and len(w) == 1 + len({f"k{i % 5000}" for i in range(N) if i % 3})
    log = D.duplicates_log(df, "key", ["src", "id"], "src")
    assert log.count() == N - len(w)
    s = D.dedupe_summary(df, "key").collect()[0]
    assert (s.processed, s.unique) == (N, len(w))


def test_positions_with_hot_group(spark):
    df = hot(spark)
    pos = position_within(df, ["key"], ["id"], name="p")
    hot_rows = pos.filter("key = 'HOT'").agg(F.min("p"), F.max("p"), F.countDistinct("p")).collect()[0]
    assert tuple(hot_rows) == (1, N // 3, N // 3)


def test_insert_ignore_and_two_tier_with_hot_key(spark):
    df = hot(spark)
    target = df.filter("id < 10").select("key", F.col("id").alias("v"))
    out = H.insert_ignore(target, df.select("key", F.col("id").alias("v")), ["key"], ["v"])
    assert out.count() == target.count() + df.select("key").distinct().count() - target.select("key").distinct().count()
    existing = df.select(F.col("id").cast("string").alias("id"), F.lit("c").alias("companyId"),
                         F.col("key").alias("url"), F.col("src").cast("string").alias("title"))
    staged = df.filter("id % 2 = 0").select(F.col("id").alias("s"), F.lit("c").alias("companyId"),
                                            F.col("key").alias("url"), F.lit("x").alias("title"))
    m = J.two_tier_match(staged, existing)
    assert m.count() == staged.count() and m.filter("matched_id IS NULL").count() == 0


def test_duplicate_links_hot_group_is_linear(spark):
    f = hot(spark).select(F.col("id"), F.lit("Ann").alias("name"), F.col("key").alias("linkedin"),
                          F.lit(None).cast("string").alias("twitter"))
    links = ID.duplicate_links(f)
    # a star per group: exactly (group size - 1) links, never size * (size - 1) / 2
    assert links.count() == N - f.select("linkedin").distinct().count()


def _split_cases(spark):
    """Every operator that joins rows with a one-row-per-key side, a third of the rows on one key."""
    from listinglake.operators import split as SP
    from listinglake.operators import validate as V
    rows = spark.range(0, 300_000, 1, 8).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS v", "uuid() AS pad")
    existing = spark.range(0, 300_000, 7).selectExpr("if(id % 2 = 0, -1, id) AS k", "id")
    parents = existing.filter("k > 0")
    text = rows.selectExpr("cast(v AS string) AS id", "cast(k AS string) AS name", "'x' AS linkedin", "cast(null AS string) AS twitter", "pad")
    staged = rows.selectExpr("k AS companyId", "concat('u', k) AS url", "concat('t', k) AS title", "v AS s", "pad")
    jobs = existing.selectExpr("k AS companyId", "concat('u', k) AS url", "concat('t', k) AS title", "id")
    no_title = staged.selectExpr("companyId", "'' AS url", "title", "s", "pad")
    return {
        "match_existing": lambda: J.match_existing(rows, existing, ["k"]), "new_jobs": lambda: J.new_jobs(rows, parents, ["k"]),
        "orphans": lambda: J.orphans(rows, parents, "k", "k"),
        "two_tier_match by url": lambda: J.two_tier_match(staged, jobs), "two_tier_match by title": lambda: J.two_tier_match(no_title, jobs),
        "duplicates_log": lambda: D.duplicates_log(rows.withColumn("src", F.lit("s")), "k", ["v"], "src"),
        "duplicate_links": lambda: ID.duplicate_links(text, via=("linkedin",)),
        "choose_survivors": lambda: ID.choose_survivors(text, rows.selectExpr("cast(v AS string) AS id", "cast(k AS string) AS component"), "id", ["pad"]),
        "large star": lambda: ID._large_star(rows.selectExpr("v + 1 AS a", "k + 1 AS b").filter("a > b")),
        "reject_unknown_parent": lambda: V.reject_unknown_parent(rows, parents, "k", "k")[1],
        "split_halves": lambda: SP.split_halves(parents.union(existing.limit(1)), rows, ["id"], "k", "k"),
        "position_within": lambda: position_within(rows, ["k"], ["v"]),
        "upsert_dimension_checked": lambda: H.upsert_dimension_checked(
            existing.selectExpr("concat('o', id) AS slug", "concat('n', id) AS name").limit(0),
            rows.selectExpr("cast(v AS string) AS slug", "cast(k AS string) AS name", "v AS o", "pad"), "slug", "name", "o", ["name"])[1],
    }


def test_hot_key_is_split(spark):
    """A third of the rows on one key, no run-time broadcast: the final plan splits the hot partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    unsplit = []
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name, make in _split_cases(spark).items():
            df = make()
            df.write.format("noop").mode("overwrite").save()
            done = df.agg(F.sum(F.hash(*df.columns).cast("decimal(38,0)")))  # every column is needed, one row comes back
            done.collect()
            if "skew=true" not in done._jdf.queryExecution().executedPlan().toString():
                unsplit.append(name)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert not unsplit


def test_null_groups_of_every_type_stay(spark):
    from listinglake.operators.positions import position_within
    for kind in ("decimal(10,2)", "timestamp", "binary", "struct<a:int>"):
        df = spark.sql(f"SELECT CAST(NULL AS {kind}) AS g, id FROM range(3)")
        assert sorted(r.pos for r in position_within(df, ["g"], ["id"]).collect()) == [1, 2, 3], kind


def test_orphans_of_mixed_nullability(spark):
    from listinglake.operators import joins as J
    children = spark.sql("SELECT CAST(NULL AS BIGINT) AS k UNION ALL SELECT 1 UNION ALL SELECT 9")
    assert {r.k for r in J.orphans(children, spark.range(5).withColumnRenamed("id", "k"), "k", "k").collect()} == {None, 9}
