"""Operator edge cases (FIXTURES §2) on small literal frames."""

from pyspark.sql import functions as F

from listinglake.operators import aggregates as A
from listinglake.operators import dedupe as D
from listinglake.operators import identity as ID
from listinglake.operators import joins as J
from listinglake.operators import merge as H
from listinglake.operators.diff import compare_snapshots, diff_counts
from listinglake.operators.split import company_halves, split_halves
from listinglake.operators.positions import global_position, position_within


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((v is None, v) for v in t))


def test_first_wins_declared_order_and_missing_keys(spark):
    order = ["a16z", "sequoia", "sequoia_IN", "lightspeed"]
    df = spark.createDataFrame([
        ("x.com", None, "lightspeed", "f1", 1), ("x.com", None, "sequoia", "f2", 1), ("x.com", None, "a16z", "f3", 9),
        (None, None, "sequoia", "f4", 1), ("", None, "a16z", "f5", 2), (None, "y.com", "lightspeed", "f6", 1),
    ], "domain string, companyDomain string, src string, file string, pos int")
    df = df.withColumn("rank", D.source_rank("src", order))
    out = D.first_wins(df, D.domain_key(), ["rank", "file", "pos"])
    assert rows(out, "src", "file") == [("a16z", "f3"), ("a16z", "f5"), ("lightspeed", "f6")]
    s = D.dedupe_summary(df, D.domain_key()).collect()[0]
    assert (s.processed, s.unique, s.duplicates) == (6, 3, 3)
    log = D.duplicates_log(df, D.domain_key(), ["rank", "file", "pos"], "src")
    assert rows(log, "file", "winner_source") == [("f1", "a16z"), ("f2", "a16z"), ("f4", "a16z")]


def test_job_key_undefined_and_case(spark):
    df = spark.createDataFrame([("x", "Dev", 1), ("X", "dev", 2), (None, "A", 3), (None, "B", 4)],
                               "companyDomain string, title string, o int")
    out = D.first_wins(df, D.job_key(), ["o"])
    assert rows(out, "o") == [(1,), (3,), (4,)]


def test_distinct_on_nulls_first_and_tie(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (1, None, "b"), (2, 3.0, "a"), (2, 3.0, "b")],
                               "job int, mn double, c string")
    out = D.distinct_on(df, "job", [F.col("mn").desc_nulls_first(), F.col("c")])
    assert rows(out, "job", "c") == [(1, "b"), (2, "a")]


def test_positions_exact(spark):
    df = spark.range(0, 1000).withColumn("g", (F.col("id") % 3).cast("int"))
    pos = global_position(df, [F.col("id").desc()], name="p")
    assert rows(pos.filter("id in (999, 0)"), "id", "p") == [(0, 1000), (999, 1)]
    within = position_within(df, ["g"], ["id"], name="p")
    assert rows(within.filter("id in (0, 1, 3, 998)"), "id", "p") == [(0, 1), (1, 1), (3, 2), (998, 333)]


def test_insert_ignore_null_keys_and_batch_first(spark):
    target = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    src = spark.createDataFrame([("a", 10), ("b", 11), ("b", 12), (None, 13), (None, 14)], "k string, v int")
    out = H.insert_ignore(target, src, ["k"], ["v"])
    assert rows(out, "k", "v") == [("a", 1), ("b", 11), (None, 2), (None, 13), (None, 14)]


def test_upsert_keeps_id_and_counter(spark):
    target = spark.createDataFrame([("s1", "id1", "old", 5), ("s2", "id2", "same", 7)], "slug string, id string, name string, numJobs int")
    src = spark.createDataFrame([("s1", "new-id", "new", 0, 1), ("s1", "x", "older", 0, 0), ("s3", "id3", "n3", 0, 1)],
                                "slug string, id string, name string, numJobs int, o int")
    out = H.upsert(target, src, "slug", ["name"], ordinal="o", keep=["id", "numJobs"])
    assert rows(out, "slug", "id", "name", "numJobs") == [("s1", "id1", "new", 5), ("s2", "id2", "same", 7),
                                                           ("s3", "id3", "n3", 0)]


def test_two_tier_match(spark):
    existing = spark.createDataFrame([("j1", "c", "u1", "T1"), ("j2", "c", "u2", "T2"), ("j3", "c", None, "T3")],
                                     "id string, companyId string, url string, title string")
    staged = spark.createDataFrame([(1, "c", "u2", "T1"), (2, "c", "", "T3"), (3, "c", "u9", "T9"), (4, "z", "u1", "T1")],
                                   "s int, companyId string, url string, title string")
    out = J.two_tier_match(staged, existing)
    assert rows(out, "s", "matched_id", "match_tier") == [(1, "j2", 1), (2, "j3", 2), (3, None, None), (4, None, None)]


def test_upsert_jobs_two_tier_collapse(spark):
    target = spark.createDataFrame([("j1", "c", "u1", "T1", 1.0)], "id string, companyId string, url string, title string, s double")
    staged = spark.createDataFrame([("c", "u1", "T1", 2.0, 1), ("c", "u1", "T1b", 3.0, 2), ("c", "u7", "N", 4.0, 3),
                                    ("c", "u8", "N", 5.0, 4)],
                                   "companyId string, url string, title string, s double, ordinal int")
    out = H.upsert_jobs(target, staged, mode="two_tier")
    got = rows(out, "url", "title", "s")
    assert ("u1", "T1b", 3.0) in got and ("u8", "N", 5.0) in got and len(got) == 2


def test_compare_snapshots(spark):
    a = spark.createDataFrame([(1, "u1", "A"), (2, "u2", ""), (3, None, "C"), (4, "u4", "D")], "id int, url string, company string")
    b = spark.createDataFrame([(1, "zz", "A", 1), (9, "u2", "B", 2), (8, "u2", "B", 3), (7, None, "E", 4)],
                              "id int, url string, company string, o int")
    d = compare_snapshots(a, b, b_order="o")
    assert rows(d, "kind", "id", "other_id") == [("by_id", 1, 1), ("by_url", 2, 8), ("only_a", 3, None),
                                                 ("only_a", 4, None), ("only_b", 7, None)]
    counts = {(r.kind, r.company): r.n for r in diff_counts(d).collect()}
    assert counts[("by_url", "Unknown")] == 1 and counts[("only_a", None)] == 2


def test_duplicate_links_and_merge(spark):
    f = spark.createDataFrame([
        (1, "Ann", "in/a", None, "bio"), (2, "Ann", "in/a", "@x", None), (3, "Ann", "", "@x", None),
        (4, "Ann", None, None, None), (5, "Bob", "", "", None), (6, "Bob", "", "", "b")],
        "id long, name string, linkedin string, twitter string, bio string")
    links = ID.duplicate_links(f)
    assert rows(links, "id", "dup_of", "via") == [(2, 1, "linkedin"), (3, 2, "twitter")]
    bridge = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 12)], "founderId long, companyId long")
    survivors, rewired, mapping = ID.merge_founders(f, bridge)
    # 1 and 2 are equally complete (3 fields each) → the smaller id survives
    assert rows(mapping.filter("old_id <= 4"), "old_id", "new_id") == [(1, 1), (2, 1), (3, 1), (4, 4)]
    assert rows(rewired, "founderId", "companyId") == [(1, 10), (1, 11), (4, 12)]
    assert rows(survivors, "id") == [(1,), (4,), (5,), (6,)]


def test_split_halves(spark):
    comps = spark.createDataFrame([("a",), ("b",), ("c",)], "d string")
    jobs = spark.createDataFrame([(1, "a"), (2, "c"), (3, "zz"), (4, "b")], "j int, d string")
    assert rows(company_halves(comps, ["d"]), "d", "half") == [("a", "A"), ("b", "A"), ("c", "B")]
    assert rows(split_halves(comps, jobs, ["d"], "d", "d"), "j", "half") == [(1, "A"), (2, "B"), (3, "orphan"), (4, "A")]


def test_dense_counts_zero_rows_and_first_rule(spark):
    df = spark.createDataFrame([("Apple Google JV",), ("Microsoft",), ("",), (None,)], "company string")
    out = {r.category: r.n for r in A.count_by_category(df).collect()}
    assert out == {"microsoft": 1, "apple": 1, "meta": 0, "amazon": 0, "netflix": 0, "google": 0, "unknown": 2, "total": 4}
    st = spark.createDataFrame([(" Active ",), ("acquired",), ("x",), (None,)], "status string")
    assert {r.status_bucket: r.n for r in A.status_counts(st).collect()} == {"active": 1, "acquired": 1, "inactive": 0,
                                                                             "unknown": 2}


def test_resolve_employer_reasons(spark):
    df = spark.createDataFrame([("amazon", None), ("Foo", "https://careers.google.com/x"), ("", "https://x.org"),
                                ("Foo", "https://x.org"), (None, None)], "company string, url string")
    out = J.resolve_employer(df)
    assert [(r.employer, r.match_source, r.reject_reason) for r in out.collect()] == [
        ("Amazon", "company_name", None), ("Google", "url_pattern", None), (None, None, "No company name"),
        (None, None, "Company not in FAANG list and URL not matching"), (None, None, "No company name")]


def test_rewire_bridge_no_duplicates(spark):
    bridge = spark.createDataFrame([(1, 10), (2, 10), (2, 11)], "f long, c long")
    mapping = spark.createDataFrame([(2, 1)], "old_id long, new_id long")
    assert rows(J.rewire_bridge(bridge, mapping, "f", "c"), "f", "c") == [(1, 10), (1, 11)]


def test_connected_components_long_chain_and_isolated(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "src long, dst long")
    nodes = spark.range(0, 103)
    comps = ID.connected_components(nodes, edges, node="id", src="src", dst="dst")
    got = {r.id: r.component for r in comps.collect()}
    assert all(got[i] == 0 for i in range(61))
    assert got[100] == 100 and got[101] == 100 and got[102] == 102 and got[61] == 61


def test_orphans_null_safe_keys(spark):
    jobs = spark.createDataFrame([(1, "a.com"), (2, None), (3, "x.com")], "j int, d string")
    comps = spark.createDataFrame([("a.com",), (None,)], "d string")
    assert rows(J.orphans(jobs, comps, "d", "d"), "j") == [(3,)]
    comps2 = spark.createDataFrame([("a.com",), ("b.com",)], "d string")
    assert rows(J.orphans(jobs, comps2, "d", "d"), "j") == [(2,), (3,)]
    assert rows(J.childless(comps2, jobs, "d", "d"), "d") == [("b.com",)]


def test_keyword_search_like_semantics(spark):
    from listinglake.operators.filters import search_all_keywords
    df = spark.createDataFrame([(1, "Senior DATA engineer"), (2, "dataKing"), (3, "a_b c"), (4, None), (5, "")],
                               "i int, desc string")
    assert rows(search_all_keywords(df, "data Engineer"), "i") == [(1,)]
    assert rows(search_all_keywords(df, "datak"), "i") == []          # only A–Z fold (KELVIN SIGN stays)
    assert rows(search_all_keywords(df, "a_b"), "i") == [(3,)]       # '_' is a one-character wildcard
    assert rows(search_all_keywords(df, "a%c"), "i") == [(3,)]       # '%' spans
    assert rows(search_all_keywords(df, ""), "i") == [(1,), (2,), (3,), (5,)]  # empty token: any non-NULL
