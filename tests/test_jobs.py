"""Composite jobs K1–K6 on small landed fixtures (JSON files written to a temp folder)."""

import json
import os

from pyspark.sql import functions as F

from listinglake import schemas as SC
from listinglake.plans import jobs as K
from listinglake.sources import readers as R


def write(path, obj, raw=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(raw if raw is not None else json.dumps(obj))


def comp(name, slug, domain, num_jobs, **kw):
    d = {"name": name, "slug": slug, "domain": domain, "numJobs": num_jobs, "markets": ["AI", "", "Fintech"],
         "stages": ["Seed"], "officeLocations": ["NYC"], "investors": ["Big Fund", "Small Fund"],
         "investorSlugs": ["big-fund"], "staffCount": 0, "isFeatured": None}
    d.update(kw)
    return d


def job(title, slug, domain, url, **kw):
    d = {"title": title, "companySlug": slug, "companyDomain": domain, "url": url, "remote": True,
         "locations": ["Berlin", {"label": "Paris"}], "salary": {"minValue": "100", "maxValue": 0, "currency": {"value": "EUR"},
                                                               "period": "yearly"}}
    d.update(kw)
    return d


def portfolio_tree(root):
    write(f"{root}/a16z/companies.json", {"companies": [comp("Acme", "acme", "acme.com", 2), comp("Beta", "beta", None, 0)]})
    write(f"{root}/a16z/notes.txt", None, raw="not json")
    write(f"{root}/sequoia/companies.json", [comp("Acme Dup", "acme", "acme.com", 5), comp("Gamma", "gamma", "g.com", None),
                                             comp("", "noname", "n.com", 1)])
    write(f"{root}/sequoia/broken.json", None, raw="[{broken")
    write(f"{root}/a16z_jobs/acme.json", {"jobs": [job("Dev", "acme", "acme.com", "u1"), job("PM", "acme", "acme.com", None)]})
    write(f"{root}/ls_jobs/acme.json", [job("dev", "acme", "acme.com", "u9"), job("Ops", "gamma", "g.com", "u3")])
    write(f"{root}/seq_jobs/beta.json", {"jobs": [job("Dev", "acme", "acme.com", "u5"), job("", "beta", None, "x")]})
    companies = [("a16z", "a16z", "A16Z"), ("sequoia", "sequoia", None), ("lightspeed", "lightspeed", "LS")]
    jobs = [("a16z", "a16z_jobs", "A16Z"), ("lightspeed", "ls_jobs", "LS"), ("sequoia", "seq_jobs", "SEQ")]
    return companies, jobs


def test_read_wrapped_shapes(spark, tmp_dir):
    write(f"{tmp_dir}/a.json", [{"name": "A", "slug": "a"}, {"name": "B", "slug": "b"}])
    write(f"{tmp_dir}/b.json", {"companies": [{"name": "C", "slug": "c"}]})
    write(f"{tmp_dir}/c.json", {"other": 1})
    write(f"{tmp_dir}/d.json", None, raw="{oops")
    write(f"{tmp_dir}/e.txt", [{"name": "X", "slug": "x"}])
    rows, errors = R.read_wrapped_json(spark, tmp_dir, "companies", SC.PORTFOLIO_COMPANY)
    got = sorted((r.file_name, r.pos, r.slug) for r in rows.collect())
    assert got == [("a.json", 1, "a"), ("a.json", 2, "b"), ("b.json", 1, "c")]
    assert [r.file_name for r in errors.collect()] == ["d.json"]


def test_read_entity_dir(spark, tmp_dir):
    write(f"{tmp_dir}/acme.json", {"slug": "acme", "name": "Acme", "status": "Active"})
    write(f"{tmp_dir}/beta_jobs.json", {"slug": "beta", "status": "Inactive"})
    write(f"{tmp_dir}/bad.json", None, raw="{nope")
    ok, bad = R.read_entity_dir(spark, tmp_dir, ".json", SC.DIRECTORY_DETAILS)
    assert sorted(r.slug for r in ok.collect()) == ["acme", "beta_jobs"]
    assert [r.slug for r in bad.collect()] == ["bad"]
    ok2, _ = R.read_entity_dir(spark, tmp_dir, "_jobs.json", SC.DIRECTORY_JOBS)
    assert [r.slug for r in ok2.collect()] == ["beta"]


def test_consolidate_portfolio(spark, tmp_dir):
    creg, jreg = portfolio_tree(tmp_dir)
    out = K.consolidate_portfolio(spark, tmp_dir, creg, jreg)
    assert sorted((r.slug, r.sourceFolder) for r in out["companies"].collect()) == [
        ("acme", "a16z"), ("beta", "a16z"), ("gamma", "sequoia"), ("noname", "sequoia")]
    s = out["company_summary"].collect()[0]
    assert (s.processed, s.unique, s.duplicates) == (5, 4, 1)
    # job order: a16z, lightspeed, sequoia — 'dev' (lightspeed) loses to 'Dev' (a16z) by key case
    winners = sorted((r.title, r.sourceFolder) for r in out["jobs"].collect())
    assert ("Dev", "a16z_jobs") in winners and ("dev", "ls_jobs") not in winners
    assert {r.problem for r in out["log"].collect()} == {None, "missing folder"}
    halves = {r.half for r in out["job_halves"].collect()}
    assert halves <= {"A", "B", "orphan"}


def test_load_portfolio_and_idempotence(spark, tmp_dir):
    creg, jreg = portfolio_tree(tmp_dir)
    k1 = K.consolidate_portfolio(spark, tmp_dir, creg, jreg)
    wh0 = K.empty_warehouse(spark)
    wh1, rejects = K.load_portfolio(wh0, k1["companies"], k1["jobs"], mode="upsert")
    companies = {r.slug: r for r in wh1["company"].collect()}
    assert set(companies) == {"acme", "beta", "gamma"}
    assert companies["acme"].staffCount is None  # 0 is falsy
    assert {r.kind for r in rejects.collect()} == {"company", "job"}
    assert sorted(r.name for r in wh1["market"].collect()) == ["AI", "Fintech"]
    assert wh1["company_market"].count() == 6
    inv = sorted((r.name, r.slug) for r in wh1["investor"].collect())
    assert inv == [("Big Fund", "big-fund"), ("Small Fund", "small-fund")]
    jobs = wh1["job"].collect()
    # Dev + PM (acme), Ops (gamma); the beta job has an empty title and is rejected
    assert len(jobs) == 3 and all(j.dataCompleteness == "COMPLETE" for j in jobs)
    num = {r.slug: r.numJobs for r in wh1["company"].collect()}
    assert num["acme"] == 2 and num["gamma"] == 1 and num["beta"] == 0
    sal = wh1["salary_range"].collect()
    assert len(sal) == 3 and all(s.minValue == 100.0 and s.maxValue is None and s.currency == "EUR" for s in sal)
    assert wh1["job_office"].count() == 6
    wh2, _ = K.load_portfolio(wh1, k1["companies"], k1["jobs"], mode="upsert")
    for name in ["company", "job", "market", "company_market", "job_office", "salary_range", "investor"]:
        a = sorted(map(str, wh1[name].collect()))
        b = sorted(map(str, wh2[name].collect()))
        assert a == b, name


def directory_frames(spark):
    base = spark.createDataFrame([
        {"slug": "acme", "name": "Acme", "batch": "W21", "website": "https://www.acme.com", "team_size": 0,
         "all_locations": "San Francisco, CA, USA", "status": "Active", "stage": "Seed", "launched_at": 1600000000,
         "top_company": True, "industries": ["AI"], "tags": ["", "B2B"], "regions": ["Remote"]},
        {"slug": "zeta", "name": "Zeta", "website": None, "team_size": 5, "industries": None, "tags": None},
    ], SC.DIRECTORY_BASE)
    details = spark.createDataFrame([
        {"slug": "acme", "website": "https://acme.io", "teamSize": 12, "status": "", "jobCount": 2,
         "founders": [{"name": "Ann", "title": "CEO", "bio": "b", "social_links": {"linkedin": "in/ann"}},
                      {"name": "Ann", "title": "CEO", "bio": "b", "social_links": {"linkedin": "in/ann"}}],
         "social_links": {"linkedin": "l", "github": "g"}},
    ], SC.DIRECTORY_DETAILS)
    jobs = spark.createDataFrame([
        {"slug": "acme", "status": "Active", "jobPostings": [
            {"title": "Senior Engineer", "url": "/companies/acme/jobs/1", "type": "Full Time", "location": "Remote",
             "createdAt": "3 months ago", "minExperience": "3+ years", "salaryRange": "$120K - $150K"},
            {"title": "Engineering Manager", "url": "/companies/acme/jobs/2", "type": "Contract",
             "createdAt": None, "salaryRange": ""}], "socialLinks": {"twitter": "t"}},
    ], SC.DIRECTORY_JOBS)
    return base, details, jobs


def test_format_and_load_directory(spark):
    base, details, jobs = directory_frames(spark)
    fmt = K.format_directory(base, details, jobs, "2024-03-31 00:00:00")
    c = {r.slug: r for r in fmt["companies"].collect()}
    assert c["acme"].domain == "acme.io" and c["acme"].numJobs == 2 and c["zeta"].numJobs == 0
    assert c["acme"].staffCount == 12 and c["acme"].isFeatured and c["acme"].isRemoteFriendly
    assert c["acme"].markets == ["AI", "B2B"] and c["acme"].offices == ["San Francisco", "CA", "USA"]
    assert c["acme"].socialLinks == {"linkedin": "l", "twitter": "t"}
    j = {r.title: r for r in fmt["jobs"].collect()}
    assert j["Senior Engineer"].url == "https://www.ycombinator.com/companies/acme/jobs/1"
    assert j["Senior Engineer"].remote and j["Senior Engineer"].minYearsExp == 3
    assert j["Senior Engineer"].salaryRange.min_value == 120000.0
    assert j["Engineering Manager"].manager and j["Engineering Manager"].contractor
    assert j["Engineering Manager"].salaryRange is None
    wh, rej = K.load_directory(K.empty_warehouse(spark), fmt["companies"], fmt["jobs"])
    assert wh["company"].count() == 2 and wh["job"].count() == 2
    assert wh["founder"].count() == 1 and wh["company_founder"].count() == 1
    assert wh["salary_range"].count() == 1
    assert sorted(r.location for r in wh["office"].collect()) == ["CA", "Remote", "San Francisco", "USA"]
    wh2, _ = K.load_directory(wh, fmt["companies"], fmt["jobs"])
    assert wh2["job"].count() == 2 and wh2["company"].count() == 2


def test_load_flat_feed_and_unify(spark, tmp_dir):
    flat = spark.createDataFrame([
        ("1", "Dev", "<b>x</b>", "2024-01-01", " Seattle ", "https://www.amazon.jobs/en/jobs/1", "amazon"),
        ("2", "Dev", "d", "bad date", "Seattle", "https://www.amazon.jobs/en/jobs/1", "Amazon"),
        ("3", "", None, None, None, "https://careers.google.com/x", None),
        ("4", "X", "d", None, None, "https://x.org", "Foo"),
        ("5", "Y", "d", None, None, None, ""),
    ], SC.FLAT_JOB)
    wh, report = K.load_flat_feed(K.empty_warehouse(spark), flat, "2024-03-31 00:00:00")
    jobs = wh["job"].collect()
    assert len(jobs) == 2
    assert {j.title for j in jobs} == {"Dev", "Untitled Job"}
    assert sorted(r.name for r in wh["company"].collect()) == sorted(["Amazon", "Apple", "Google", "Meta", "Microsoft",
                                                                     "Netflix"])
    assert {r.reject_reason: r.n for r in report["by_reason"].collect()} == {
        "No company name": 1, "Company not in FAANG list and URL not matching": 1}
    assert wh["job_office"].count() == 1
    creg, jreg = portfolio_tree(tmp_dir)
    k1 = K.consolidate_portfolio(spark, tmp_dir, creg, jreg)
    base, details, djobs = directory_frames(spark)
    fmt = K.format_directory(base, details, djobs, "2024-03-31 00:00:00")
    all_wh = K.unify(K.empty_warehouse(spark), (k1["companies"], k1["jobs"]), flat, (fmt["companies"], fmt["jobs"]),
                     as_of="2024-03-31 00:00:00")
    slugs = {r.slug for r in all_wh["company"].collect()}
    assert {"acme", "beta", "gamma", "zeta", "amazon"} <= slugs
    assert all_wh["company"].filter(F.col("slug") == "acme").count() == 1


def test_commit_and_reload_warehouse(spark, tmp_dir):
    creg, jreg = portfolio_tree(tmp_dir + "/landing")
    k1 = K.consolidate_portfolio(spark, tmp_dir + "/landing", creg, jreg)
    wh, _ = K.load_portfolio(K.empty_warehouse(spark), k1["companies"], k1["jobs"])
    versions = K.commit_warehouse(wh, tmp_dir + "/wh", buckets=4)
    assert set(versions.values()) == {1}
    back = K.load_warehouse(spark, tmp_dir + "/wh")
    assert back["company"].count() == 3 and back["job"].count() == 3
    wh2, _ = K.load_portfolio(back, k1["companies"], k1["jobs"])
    assert sorted(map(str, wh2["job"].collect())) == sorted(map(str, wh["job"].collect()))


def test_bad_elements_and_files_are_reported(spark, tmp_dir):
    write(f"{tmp_dir}/s/a.json", None, raw='[{"slug": "a", "name": "A"}, "oops", {"slug": "b", "name": "B", "markets": ["x"]}, 3]')
    write(f"{tmp_dir}/s/b.json", {"companies": {"slug": "c"}})
    write(f"{tmp_dir}/s/c.json", {"companies": [{"slug": "d"}]})
    write(f"{tmp_dir}/s/d.json", None, raw="[{broken")
    out = K.consolidate_portfolio(spark, tmp_dir, [("s", "s", None)], [])
    rows, _ = R.read_wrapped_json(spark, f"{tmp_dir}/s", "companies", SC.PORTFOLIO_COMPANY)
    assert sorted((r.file_name, r.pos, r.slug, r.markets) for r in rows.collect()) == [
        ("a.json", 1, "a", None), ("a.json", 3, "b", ["x"]), ("c.json", 1, "d", None)]
    assert {(r.file_name, r.pos, r.reason) for r in out["read_errors"].collect()} == {
        ("a.json", 2, "record is no JSON object"), ("a.json", 4, "record is no JSON object"),
        ("b.json", None, "companies is no array"), ("d.json", None, "unreadable JSON")}


def portfolio_frames(spark, jobs):
    comps = spark.createDataFrame([{"name": "Acme", "slug": "acme", "domain": "acme.com", "investors": ["Inv", "Inv"],
                                    "investorSlugs": ["inv", "inv-2"]}], SC.PORTFOLIO_COMPANY)
    rows = spark.createDataFrame([{"companySlug": "acme"} | j for j in jobs], SC.PORTFOLIO_JOB)
    def landed(df):
        return df.coalesce(1).withColumn("file_name", F.lit("f")).withColumn("pos", F.monotonically_increasing_id().cast("int"))
    return landed(comps).withColumn("dataSource", F.lit("P")), landed(rows)


def test_upsert_keeps_columns_of_other_feeds(spark):
    base, details, jobs = directory_frames(spark)
    fmt = K.format_directory(base, details, jobs, "2024-03-31 00:00:00")
    wh, _ = K.load_directory(K.empty_warehouse(spark), fmt["companies"], fmt["jobs"])
    wh["job"] = K.materialize(wh["job"].withColumn("description", F.lit("text")).withColumn("equityRange", F.lit("1%")))
    comps, pj = portfolio_frames(spark, [{"title": "Senior Engineer", "url": "u", "minYearsExp": 0, "dataSource": "P"}])
    out, rejects = K.load_portfolio(wh, comps, pj)
    j = out["job"].filter("title = 'Senior Engineer'").collect()
    assert [(r.url, r.description, r.equityRange, r.dataSource, r.minYearsExp) for r in j] == [("u", "text", "1%", "P", None)]
    assert sorted((r.name, r.slug) for r in out["investor"].collect()) == [("Inv", "inv")]
    assert out["company_investor"].count() == 1
    assert [(r.kind, r.key) for r in rejects.collect()] == [("investor", "inv-2")]


def test_insert_mode_links_by_ordinal(spark):
    comps, pj = portfolio_frames(spark, [
        {"title": "Dev", "url": "u1", "locations": ["Paris"], "salary": {"minValue": "1"}},
        {"title": "Dev", "url": "u2", "locations": ["Rome"], "salary": {"minValue": "2"}},
        {"title": "Dev", "locations": ["Oslo"]}, {"title": "Dev", "locations": ["Bern"]}])
    wh, _ = K.load_portfolio(K.empty_warehouse(spark), comps, pj, mode="insert")
    wh = K.materialize_all(wh)
    again, _ = K.load_portfolio(wh, comps, pj, mode="insert")
    for state in (wh, again):
        jobs = state["job"].select(F.col("id").alias("jobId"), "url")
        assert jobs.count() == 4 and jobs.select("jobId").distinct().count() == 4
        places = state["job_office"].join(state["office"].withColumnRenamed("id", "officeId"), "officeId").join(jobs, "jobId")
        assert sorted((r.url or "", r.location) for r in places.collect()) == [("", "Bern"), ("", "Oslo"), ("u1", "Paris"), ("u2", "Rome")]
        pay = state["salary_range"].join(jobs, "jobId")
        assert sorted((r.url, r.minValue) for r in pay.collect()) == [("u1", 1.0), ("u2", 2.0)]


def test_a_renamed_jobs_old_title_comes_back(spark):
    wh = K.empty_warehouse(spark)
    for title, url in (("A", "u"), ("B", "u"), ("A", "v"), ("A", "u")):  # the directory renames by url
        staged = spark.createDataFrame([("c", url, title, 1)], "companyId string, url string, title string, ordinal int")
        wh["job"] = K.materialize(K.conform(K.H.upsert_jobs(wh["job"], staged, mode="two_tier", replace=["title", "url"]), SC.JOB))
    moved = spark.createDataFrame([("c", "w", "A", 1)], "companyId string, url string, title string, ordinal int")
    out = K.H.upsert_jobs(wh["job"], moved, mode="two_tier", replace=["title", "url"]).collect()
    assert len({r.id for r in out}) == len(out)


def test_directory_job_offices_and_salaries_without_url(spark):
    base, details, _ = directory_frames(spark)
    jobs = spark.createDataFrame([{"slug": "acme", "status": "Active", "jobPostings": [
        {"title": "Eng", "url": "/companies/acme/jobs/1", "location": "Berlin", "salaryRange": "$100K - $120K"},
        {"title": "Eng", "url": "/companies/acme/jobs/2", "location": "Lima", "salaryRange": "$110K - $130K"},
        {"title": "PM", "url": None, "location": "Rome", "salaryRange": "$90K - $95K"}]}], SC.DIRECTORY_JOBS)
    fmt = K.format_directory(base, details, jobs, "2024-03-31 00:00:00")
    wh, _ = K.load_directory(K.empty_warehouse(spark), fmt["companies"], fmt["jobs"])
    j = wh["job"].select(F.col("id").alias("jobId"), "title")
    places = wh["job_office"].join(wh["office"].withColumnRenamed("id", "officeId"), "officeId").join(j, "jobId")
    assert sorted((r.title, r.location) for r in places.collect()) == [("Eng", "Berlin"), ("Eng", "Lima"), ("PM", "Rome")]
    assert sorted((r.title, r.minValue) for r in wh["salary_range"].join(j, "jobId").collect()) == [("Eng", 110000.0), ("PM", 90000.0)]


def test_later_record_of_a_slug_wins_by_feed_order(spark):
    base, details, jobs = directory_frames(spark)
    one = base.filter("slug = 'zeta'").drop("name")
    again = one.withColumn("name", F.lit("Zeta late")).withColumn("file_name", F.lit("b.json")).withColumn("pos", F.lit(1))
    first = one.withColumn("name", F.lit("A early")).withColumn("file_name", F.lit("a.json")).withColumn("pos", F.lit(9))
    for both in (again.unionByName(first), first.unionByName(again)):
        fmt = K.format_directory(both, details, jobs, "2024-03-31 00:00:00")
        wh, _ = K.load_directory(K.empty_warehouse(spark), fmt["companies"], fmt["jobs"])
        assert [r.name for r in wh["company"].collect()] == ["Zeta late"]


def test_flat_feed_order_is_numeric_and_repeats_add_nothing(spark):
    url = "https://www.amazon.jobs/en/jobs/1"
    flat = spark.createDataFrame([("10", "ten", None, None, None, url, "amazon"),
                                  ("9", "nine", None, None, None, url, "amazon"),
                                  ("x", "no url", None, None, None, None, "amazon")], SC.FLAT_JOB)
    wh, _ = K.load_flat_feed(K.empty_warehouse(spark), flat, "2024-03-31 00:00:00")
    wh, _ = K.load_flat_feed(wh, flat, "2024-03-31 00:00:00")
    assert sorted(r.title for r in wh["job"].collect()) == ["nine", "no url"]
