"""Composite jobs (K1–K6): the user-facing consolidations and loads, each one DataFrame plan
per output (a warehouse is a dict of table name → DataFrame, the next state).

Every step is an operator from ``operators`` / ``functions``; nothing here collects data.
Commit a returned warehouse with ``sources.sinks.commit_version`` per table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as SC
from ..functions import jsonish as JS
from ..functions import parse as P
from ..functions import text as TX
from ..functions.core import or_default, or_null, to_flag, truthy
from ..functions.rules import SEED_EMPLOYERS
from ..operators import aggregates as A
from ..operators import dedupe as D
from ..operators import joins as J
from ..operators import merge as H
from ..operators.filters import split_by_has_jobs
from ..operators.flatten import drop_nested, flatten_founders, flatten_jobs, flatten_links, flatten_locations, flatten_salaries
from ..operators.sets import build_dimension, concat_arrays, union_distinct
from ..operators.split import split_halves
from ..operators.topk import top_per_group
from ..operators.joins import two_tier_match
from ..operators.validate import reject_unknown_parent, require_fields
from ..sources.readers import read_flat_jobs, read_source_tree
from ..session import settings, store, stored_columns
from ..sources.literals import empty_frame
from ..sources.staging import landing_place, stage_jobs, stage_portfolio

# Company columns replaced by an upsert of each feed.
PORTFOLIO_REPLACED = ["name", "description", "domain", "emailDomains", "staffCount", "isFeatured", "isRemoteFriendly",
               "logos", "website", "parentSlugs", "parents", "dataSource"]
DIRECTORY_REPLACED = PORTFOLIO_REPLACED[:-1] + ["oneLiner", "foundedAt", "batchInfo", "status", "dataSource"]
# Job columns replaced by an upsert of each feed; the others keep what another feed wrote.
PORTFOLIO_JOB_REPLACED = ["applyUrl", "url", "remote", "hybrid", "timeStamp", "manager", "consultant", "contractor",
                          "minYearsExp", "maxYearsExp", "skills", "requiredSkills", "preferredSkills", "departments",
                          "jobTypes", "jobFunctions", "jobSeniorities", "regions", "dataSource"]
DIRECTORY_JOB_REPLACED = ["title", *PORTFOLIO_JOB_REPLACED, "dataCompleteness", "equityRange", "roleSpecificType"]
# What a staged job carries for other tables than the job table.
POSTED = ["locations", "normalizedLocations", "salary"]
FOUNDER_REPLACED = ["name", "title", "bio", "twitter", "linkedin", "website"]
# Feed labels and the directory's public base URL.
DIRECTORY_SOURCE = "YC"
FLAT_SOURCE = "SQLITE_IMPORT"
DIRECTORY_BASE_URL = "https://www.ycombinator.com"
DEFAULT_COMPLETENESS = "COMPLETE"


def empty_warehouse(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: empty_frame(spark, schema) for name, schema in SC.WAREHOUSE.items()}


def conform(df: DataFrame, schema, extra: tuple[str, ...] = ()) -> DataFrame:
    """Select / cast to a warehouse schema; missing columns become NULL; ``extra`` columns are
    carried along unchanged."""
    have = set(df.columns)
    exprs = [f"CAST({'`' + f.name + '`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
             for f in schema.fields]
    return df.selectExpr(*exprs, *[f"`{c}`" for c in extra])  # one call, however wide the table


def materialize(df: DataFrame, name: str = "state") -> DataFrame:
    """Cut the lineage of a state consumed by several later plans: written once, columnar, in the shared folder
    (``spark.checkpoint.dir``), so a lost executor reads it from there, later plans stay small and read only
    the columns they need. Packed with zstd: ids are hash texts, of which lighter codecs leave every character."""
    return store(df, name, "zstd")


def materialize_changed(wh: dict[str, DataFrame], before: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables a load has changed, written once; the others are passed through."""
    return {name: df if df is before.get(name) else materialize(df, name) for name, df in wh.items()}


def materialize_all(wh: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: materialize(df, name) for name, df in wh.items()}


def _dedupe_union(old: DataFrame, new: DataFrame, cols: list[str]) -> DataFrame:
    return old.select(*cols).unionByName(new.select(*cols)).dropDuplicates(cols)


# ---------------------------------------------------------------------------------- K1
def consolidate_portfolio(spark: SparkSession, root: str, company_registry: list, job_registry: list,
                          top_k: int = 10, file_order: str = "file_name", glob: str = "*.json",
                          recursive: bool = False, lines: bool = False) -> dict[str, DataFrame]:
    """K1: read the per-source company and job folders in their declared orders (the two
    orders differ), first-wins dedupe with duplicate logs and summaries, profiling, top-k and
    the half split; unreadable files and records are in ``read_errors``. Inside a source, files are taken in ``file_order`` (name, or full path
    for nested layouts), records in file position. ``lines``: files with a document per line, which are split over tasks."""
    companies, clog, cerr = read_source_tree(spark, root, company_registry, "companies", SC.PORTFOLIO_COMPANY, glob, recursive, lines)
    jobs, jlog, jerr = read_source_tree(spark, root, job_registry, "jobs", SC.PORTFOLIO_JOB, glob, recursive, lines)
    order = ["source_rank", file_order, *(["line"] if lines else []), "pos"]
    ckey, jkey = D.domain_key(), D.job_key("companyDomain", "title")
    uc = D.first_wins(companies, ckey, order).withColumn("company_key", D.domain_key())
    uj = D.first_wins(jobs, jkey, order)
    with_jobs, without_jobs = split_by_has_jobs(uc, "numJobs")
    return {
        "companies": uc, "jobs": uj,
        "company_duplicates": D.duplicates_log(companies, ckey, order, "sourceFolder"),
        "job_duplicates": D.duplicates_log(jobs, jkey, order, "sourceFolder"),
        "company_summary": D.dedupe_summary(companies, ckey),
        "job_summary": D.dedupe_summary(jobs, jkey),
        "jobs_per_folder": A.counts_by(jobs, "sourceFolder"),
        "jobs_per_company": A.counts_by(uj, "companyDomain"),
        "source_stats": A.source_stats(uc, "dataSource", "numJobs"),
        "top_companies": top_per_group(uc, "dataSource", [F.col("numJobs").desc_nulls_last()] + order, top_k),
        "with_jobs": with_jobs, "without_jobs": without_jobs,
        "job_halves": split_halves(uc, uj, order, "company_key", "companyDomain"),
        "log": clog.unionByName(jlog), "read_errors": cerr.unionByName(jerr),
    }


# ---------------------------------------------------------------------------------- K2
def _staged_jobs(landed: DataFrame, company: DataFrame, collapse) -> DataFrame:
    """Staged rows of the landed jobs whose company is known, stored, one per key: ``collapse(rows, company columns, order)``
    keeps it. Landed rows are shorter than staged ones, so they are staged after they have moved. An id that no other company
    has tells its slug, so rows that the join has dealt out by slug are collapsed where they are; the join still
    splits a hot company, whose rows then move once more."""
    rows = landed.withColumn("url", or_null(F.col("url")))
    place, ids = landing_place(rows), company.select("slug", "id")
    # ids are counted by a hash of theirs: should two have the same one, only the longer way is taken
    shared = ids.groupBy(F.xxhash64("id")).agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("given")).filter("n > 1 OR given < 1")
    keys = ["companyId", "companySlug"] if shared.isEmpty() else ["companyId"]
    rows = collapse(J.attach_company(rows, ids, "companySlug"), keys, place)
    with settings(rows.sparkSession, {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}):
        return materialize(conform(stage_jobs(rows, "companyId"), SC.JOB, ("_ord", "job_key", *POSTED)), "staged-jobs")


def load_portfolio(wh: dict[str, DataFrame], companies: DataFrame, jobs: DataFrame, mode: str = "upsert"
                   ) -> tuple[dict[str, DataFrame], DataFrame]:
    """K2: staging → companies (upsert or insert-ignore by slug) → dimensions and bridges →
    jobs (title match) → job offices and salaries, carried by their staged row → job counts.
    Returns the next warehouse and the staging rejects."""
    st = stage_portfolio(companies, jobs)
    src = st["company"].withColumn("id", TX.surrogate_id("slug"))
    comp_src = conform(src, SC.COMPANY, ("_ord",))
    if mode == "upsert":
        company = H.upsert(wh["company"], comp_src, "slug", PORTFOLIO_REPLACED, ordinal="_ord", keep=["id", "numJobs"])
    elif mode == "insert":
        company = H.insert_ignore(wh["company"], comp_src, ["slug"], ["_ord"])
    else:
        raise ValueError(f"unknown mode {mode!r}")
    company = materialize(conform(company, SC.COMPANY))
    out = dict(wh)
    out["company"] = company
    for dim, bridge, dim_id in (("market", "company_market", "marketId"), ("stage", "company_stage", "stageId")):
        d = H.insert_ignore(wh[dim], build_dimension(st[dim], "name"), ["name"], ["name"])
        out[dim] = d
        links = J.link(st[dim], d, company, out=("companyId", dim_id))
        out[bridge] = _dedupe_union(wh[bridge], links, ["companyId", dim_id])
    office_names = union_distinct([st["office"].select("name"),
                                   st["job_location"].select(F.col("location_name").alias("name"))], "name")
    office = H.insert_ignore(wh["office"], build_dimension(office_names, "name").withColumnRenamed("name", "location"),
                             ["location"], ["location"])
    # stored: of known size, it may be broadcast to the links, which then do not move by the few names they have
    office = out["office"] = materialize(office, "office")
    out["company_office"] = _dedupe_union(
        wh["company_office"], J.link(st["office"], office, company, dim_name="location", out=("companyId", "officeId")),
        ["companyId", "officeId"])
    inv_src = D.last_wins(st["investor"].withColumn("_o", F.struct("company_slug", "pos")), "slug", ["_o"])
    investor, inv_rejects = H.upsert_dimension_checked(
        wh["investor"], inv_src.withColumn("id", TX.surrogate_id("slug")), "slug", "name", "_o", ["name"], keep=["id"])
    out["investor"] = conform(investor, SC.INVESTOR)
    inv_links = J.link(st["investor"].select("company_slug", "slug"), out["investor"], company, staged_name="slug",
                       dim_name="slug", out=("companyId", "investorId"))
    # an investor whose name another slug holds is linked as that one
    renamed = st["investor"].join(inv_rejects.select("slug"), "slug", "left_semi").select("company_slug", "name")
    name_links = J.link(renamed, out["investor"], company, out=("companyId", "investorId"))
    out["company_investor"] = _dedupe_union(wh["company_investor"], inv_links.unionByName(name_links),
                                            ["companyId", "investorId"])
    # jobs: the batch's row of a job keeps its locations and salary beside it, through the merge into the stored job table
    if mode == "upsert":
        def collapse(rows, company_cols, order):  # the last row of a company and title
            return D.last_wins(rows, [*company_cols, "title"], order)
    else:
        def collapse(rows, company_cols, order):
            return H.collapse_batch(rows, ["url", *company_cols], order)
    last = _staged_jobs(st["landed_job"], company, collapse)
    known = wh["job"].select("*", *[F.lit(None).cast(last.schema[c].dataType).alias(c) for c in POSTED],
                             F.lit(None).cast("boolean").alias("_fed"))
    fed = last.withColumn("_fed", F.lit(True))
    if mode == "upsert":
        job = H.upsert_jobs(known, fed.drop("id"), mode="title", ordinal="_ord",
                            replace=[*PORTFOLIO_JOB_REPLACED, *POSTED, "_fed"], collapsed=True)
    else:
        # jobs without a url have no natural key: their place in the feed tells them apart, and a job
        # loaded from the same place before is left alone
        no_url = F.col("url").isNull()
        fed = fed.withColumn("id", TX.surrogate_id("companyId", "url", "title", F.when(no_url, F.col("job_key"))))
        fresh = H.unheld_ids(fed.filter(~no_url), wh["job"], "companyId").unionByName(
            fed.filter(no_url).join(wh["job"].select("id"), "id", "left_anti").select(*fed.columns))
        job = H.insert_ignore(known, fresh, ["url", "companyId"], ["_ord"], collapsed=True)
    table = materialize(conform(job, SC.JOB, (*POSTED, "_fed")).withColumn("dataCompleteness",
                                                                         F.coalesce("dataCompleteness", F.lit(DEFAULT_COMPLETENESS))))
    job = out["job"] = stored_columns(table, SC.JOB.names)
    # what was posted, by job: an upsert wrote every job of the staged row's company and title, an insert the one
    # job of its company and url (without a url, the staged row's own), be it new or held before
    posted = table.filter("_fed").select(F.col("id").alias("jobId"), "companyId", *POSTED)
    if mode == "insert":
        by_url = wh["job"].select(F.col("id").alias("jobId"), "companyId", "url")
        held = fed.filter(~no_url).drop("id").join(by_url, ["companyId", "url"]).select(*posted.columns).unionByName(
            fed.filter(no_url).join(wh["job"].select("id"), "id", "left_semi").select(F.col("id").alias("jobId"), *posted.columns[1:]))
        posted = posted.unionByName(materialize(held, "held-jobs"))
    locations = flatten_locations(posted, "jobId", "companyId", "normalizedLocations", "locations")
    loc_links = (locations.withColumnRenamed("job_ordinal", "jobId")
                 .join(office.select(F.col("location").alias("location_name"), F.col("id").alias("officeId")),
                       "location_name").select("jobId", "officeId"))
    out["job_office"] = H.replace_links(wh["job_office"], posted.select("jobId"), loc_links, "jobId", by_key=True)
    sal = flatten_salaries(posted, "jobId").select(F.col("job_ordinal").alias("jobId"), F.col("min_value").alias("minValue"),
                                                   F.col("max_value").alias("maxValue"), "currency", "period")
    out["salary_range"] = conform(H.upsert_salary(wh["salary_range"], sal, new_id=TX.surrogate_id("jobId")), SC.SALARY_RANGE)
    out["company"] = conform(A.refresh_num_jobs(company, job, "id", "companyId"), SC.COMPANY)
    return out, st["rejects"].unionByName(inv_rejects.select(F.lit("investor").alias("kind"), F.col("slug").alias("key"), "reason"))


# ---------------------------------------------------------------------------------- K3
def format_directory(base: DataFrame, details: DataFrame, job_files: DataFrame, as_of) -> dict[str, DataFrame]:
    """K3: base ⟕ details ⟕ jobs by slug (details win where truthy), formatted companies
    (nested markets / offices / founders kept, jobs dropped with their count) and formatted
    jobs. Where the base records say where they were read (``file_name`` / ``file_path``, ``pos``), both
    outputs carry it as ``feed_order``; a load then lets the last of several records of one slug win."""
    b = base.alias("b")
    place = [F.col(f"b.{c}") for c in ("file_path", "file_name", "pos") if c in base.columns]
    carried = ["feed_order"] if place else []
    d = details.alias("d")
    j = job_files.select("slug", "jobPostings", F.col("socialLinks").alias("job_links")).alias("j")
    m = b.join(d, F.col("b.slug") == F.col("d.slug"), "left").join(j, F.col("b.slug") == F.col("j.slug"), "left")

    def prefer(dc, bc, dtype=None):
        return F.when(truthy(F.col(f"d.{dc}"), dtype), F.col(f"d.{dc}")).otherwise(F.col(f"b.{bc}"))
    merged = m.select(
        F.col("b.slug").alias("slug"), F.col("b.name").alias("name"), prefer("batch", "batch").alias("batch"),
        prefer("website", "website").alias("website"),
        F.coalesce(F.col("d.founders"), F.array().cast(details.schema["founders"].dataType)).alias("founders"),
        F.col("b.long_description").alias("long_description"), prefer("description", "long_description").alias("description"),
        prefer("teamSize", "team_size", details.schema["teamSize"].dataType).alias("teamSize"),
        F.col("b.team_size").alias("team_size"),
        prefer("location", "all_locations").alias("location"), prefer("status", "status").alias("status"),
        F.coalesce(F.col("d.jobCount"), F.lit(0)).alias("jobCount"),
        JS.merge_links(F.col("d.social_links"), F.col("j.job_links")).alias("social_links"),
        F.coalesce(F.col("j.jobPostings"), F.array().cast(job_files.schema["jobPostings"].dataType)).alias("jobPostings"),
        F.col("b.one_liner").alias("one_liner"), F.col("b.launched_at").alias("launched_at"),
        F.col("b.top_company").alias("top_company"), F.col("b.regions").alias("regions"),
        F.col("b.small_logo_thumb_url").alias("small_logo_thumb_url"), F.col("b.industries").alias("industries"),
        F.col("b.tags").alias("tags"), F.col("b.stage").alias("stage"), F.col("b.all_locations").alias("all_locations"),
        *([F.struct(*place).alias("feed_order")] if place else []))
    domain = TX.extract_domain(F.col("website"))
    companies = merged.select(
        TX.surrogate_id("slug").alias("id"), "name",
        F.coalesce(or_null(F.col("long_description")), or_null(F.col("description"))).alias("description"),
        domain.alias("domain"), JS.email_domains(domain).alias("emailDomains"),
        F.coalesce(F.when(F.col("team_size") != 0, F.col("team_size")),
                   F.when(F.col("teamSize") != 0, F.col("teamSize"))).alias("staffCount"),
        "slug", to_flag(F.col("top_company"), base.schema["top_company"].dataType).alias("isFeatured"),
        P.remote_friendly("regions").alias("isRemoteFriendly"),
        F.to_json(JS.build_logos("small_logo_thumb_url")).alias("logos"),
        F.to_json(JS.build_website("website", "name")).alias("website"),
        F.array().cast("array<string>").alias("parentSlugs"), F.array().cast("array<string>").alias("parents"),
        or_null(F.col("one_liner")).alias("oneLiner"),
        P.epoch_seconds_to_ts(F.col("launched_at")).alias("foundedAt"), or_null(F.col("batch")).alias("batchInfo"),
        or_null(F.col("status")).alias("status"), F.lit(DIRECTORY_SOURCE).alias("dataSource"),
        JS.pick_links(F.col("social_links")).alias("socialLinks"),
        F.transform(F.col("founders"), lambda f: f).alias("founders"),
        concat_arrays("industries", "tags").alias("markets"),
        F.when(truthy(F.col("stage")), F.col("stage")).alias("stage_name"),
        F.when(truthy(F.col("all_locations")), TX.split_locations(F.col("all_locations")))
         .otherwise(F.array().cast("array<string>")).alias("offices"),
        "jobPostings", *carried)
    postings = flatten_jobs(companies, "jobPostings", {"companyId": "id", "companyName": "name", "companySlug": "slug",
                                                       **{c: c for c in carried}})
    jobs = postings.select(
        TX.surrogate_id("companySlug", "posting_pos", "url").alias("id"), "companyId", "companyName", "companySlug",
        "posting_pos",
        "title", or_null(F.col("applyUrl")).alias("applyUrl"), TX.absolutise(F.col("url"), DIRECTORY_BASE_URL).alias("url"),
        P.job_flags("location", "title", "type")["remote"].alias("remote"), F.lit(False).alias("hybrid"),
        P.parse_relative_date(F.col("createdAt"), as_of).alias("timeStamp"),
        P.job_flags("location", "title", "type")["manager"].alias("manager"), F.lit(False).alias("consultant"),
        P.job_flags("location", "title", "type")["contractor"].alias("contractor"),
        P.parse_years_exp(F.col("minExperience")).alias("minYearsExp"), F.lit(None).cast("int").alias("maxYearsExp"),
        F.when(truthy(F.col("roleSpecificType")), F.array(F.col("roleSpecificType"))).alias("skills"),
        F.when(truthy(F.col("role")), F.array(F.col("role"))).otherwise(F.array().cast("array<string>")).alias("departments"),
        F.to_json(P.flag_map(F.col("type"), default="Unknown")).alias("jobTypes"),
        F.to_json(P.flag_map(F.col("roleSpecificType"))).alias("jobFunctions"),
        F.to_json(P.seniority_map(F.col("title"))).alias("jobSeniorities"),
        or_null(F.col("equityRange")).alias("equityRange"), or_null(F.col("roleSpecificType")).alias("roleSpecificType"),
        F.lit(DIRECTORY_SOURCE).alias("dataSource"), F.lit(DEFAULT_COMPLETENESS).alias("dataCompleteness"),
        F.when(truthy(F.col("location")), F.array(F.col("location"))).otherwise(F.array().cast("array<string>"))
         .alias("offices"),
        P.parse_salary(F.col("salaryRange")).alias("salaryRange"), *carried)
    return {"companies": drop_nested(companies, "jobPostings", "numJobs"), "jobs": jobs}


# ---------------------------------------------------------------------------------- K4
def load_directory(wh: dict[str, DataFrame], companies: DataFrame, jobs: DataFrame
                   ) -> tuple[dict[str, DataFrame], DataFrame]:
    """K4: formatted directory companies / jobs into the warehouse: companies upserted by slug
    (16 columns), dimensions and bridges, founders last-wins by id then upserted, jobs whose
    company is unknown rejected, jobs matched two-tier and upserted, salary ranges, counts. "Last" is
    by ``feed_order`` where the inputs carry it (companies and jobs alike), then by slug and position."""
    ok, rejects = require_fields(companies, ["slug", "name"])
    carried = [c for c in ("feed_order",) if c in companies.columns]
    job_order = [c for c in ("feed_order",) if c in jobs.columns]
    ok = (ok.withColumn("_ord", F.struct(*carried, "slug"))
            .withColumn("staffCount", or_default(F.col("staffCount"), 0, ok.schema["staffCount"].dataType))
            .withColumn("isFeatured", to_flag(F.col("isFeatured"), ok.schema["isFeatured"].dataType))
            .withColumn("isRemoteFriendly", to_flag(F.col("isRemoteFriendly"), ok.schema["isRemoteFriendly"].dataType)))
    company = materialize(conform(H.upsert(wh["company"], conform(ok, SC.COMPANY, ("_ord",)), "slug",
                                           DIRECTORY_REPLACED, ordinal="_ord", keep=["id", "numJobs"]), SC.COMPANY))
    out = dict(wh)
    out["company"] = company
    staged_m = flatten_links(ok, "slug", "markets").withColumnRenamed("slug", "company_slug")
    market = H.insert_ignore(wh["market"], build_dimension(staged_m, "name"), ["name"], ["name"])
    out["market"] = market
    out["company_market"] = _dedupe_union(wh["company_market"],
                                          J.link(staged_m, market, company, out=("companyId", "marketId")),
                                          ["companyId", "marketId"])
    staged_s = ok.filter(F.col("stage_name").isNotNull()).select(F.col("slug").alias("company_slug"),
                                                                  F.col("stage_name").alias("name"))
    stage = H.insert_ignore(wh["stage"], build_dimension(staged_s, "name"), ["name"], ["name"])
    out["stage"] = stage
    out["company_stage"] = _dedupe_union(wh["company_stage"], J.link(staged_s, stage, company, out=("companyId", "stageId")),
                                         ["companyId", "stageId"])
    staged_o = flatten_links(ok, "slug", "offices").withColumnRenamed("slug", "company_slug")
    job_locs = jobs.select(F.col("companySlug").alias("company_slug"), F.explode("offices").alias("name")) \
        .filter(truthy(F.col("name")))
    office_names = union_distinct([staged_o.select("name"), job_locs.select("name")], "name")
    office = H.insert_ignore(wh["office"], build_dimension(office_names, "name").withColumnRenamed("name", "location"),
                             ["location"], ["location"])
    out["office"] = office
    out["company_office"] = _dedupe_union(
        wh["company_office"], J.link(staged_o, office, company, dim_name="location", out=("companyId", "officeId")),
        ["companyId", "officeId"])
    founders = flatten_founders(ok, "slug", carry=tuple(carried))
    f_ok, _ = require_fields(founders, ["id", "name"])
    f_last = D.last_wins(f_ok.withColumn("_o", F.struct(*carried, "slug", "pos")), "id", ["_o"])
    out["founder"] = conform(H.upsert(wh["founder"], conform(f_last, SC.FOUNDER), "id", FOUNDER_REPLACED), SC.FOUNDER)
    out["company_founder"] = _dedupe_union(
        wh["company_founder"],
        f_ok.join(company.select(F.col("slug"), F.col("id").alias("companyId")), "slug")
            .select("companyId", F.col("id").alias("founderId")), ["companyId", "founderId"])
    # jobs: resolve the company against the warehouse, reject unknown ones
    _known, unknown = reject_unknown_parent(jobs, company, "companySlug", "slug", "unknown company")
    resolved = J.attach_company(jobs.drop("companyId"), company, "companySlug")
    staged = resolved.withColumn("ordinal", F.struct(*job_order, "companySlug", "posting_pos"))
    job_src = conform(staged, SC.JOB, ("ordinal",))
    job = materialize(conform(H.upsert_jobs(wh["job"], job_src.drop("id"), mode="two_tier", ordinal="ordinal",
                                            replace=DIRECTORY_JOB_REPLACED), SC.JOB))
    out["job"] = job
    # every posting's offices go to the job it ended in, also those of postings that a later one replaced
    # (jobs are matched within a company, so those of other companies are left out before anything is grouped)
    fed = staged.select("companyId").distinct()
    mine = materialize(job.select("id", "companyId", "url", "title").join(fed, "companyId", "left_semi"), "fed-jobs")
    placed = two_tier_match(staged.select("ordinal", "companyId", "url", "title", F.explode("offices").alias("location"))
                            .filter(truthy(F.col("location"))), mine, out="jobId")
    job_offices = placed.join(office.select("location", F.col("id").alias("officeId")), "location")
    out["job_office"] = _dedupe_union(wh["job_office"], job_offices, ["jobId", "officeId"])
    of_job = mine.select(F.col("id").alias("jobId"), *[F.col(c).alias(f"j_{c}") for c in ("companyId", "url", "title")])
    sal = (staged.filter(F.col("salaryRange").isNotNull())
           .join(of_job, (F.col("companyId") == F.col("j_companyId")) & (F.col("title") == F.col("j_title"))
                 & F.col("url").eqNullSafe(F.col("j_url")))
           .select("jobId", F.col("salaryRange.min_value").alias("minValue"), F.col("salaryRange.max_value").alias("maxValue"),
                   F.col("salaryRange.currency").alias("currency"), F.col("salaryRange.period").alias("period"))
           .withColumn("id", TX.surrogate_id("jobId")))
    out["salary_range"] = conform(H.upsert_salary(wh["salary_range"], sal), SC.SALARY_RANGE)
    out["company"] = conform(A.refresh_num_jobs(company, job, "id", "companyId"), SC.COMPANY)
    rej = rejects.select(F.lit("company").alias("kind"), F.col("slug").alias("key"), "reason").unionByName(
        unknown.select(F.lit("job").alias("kind"), F.col("companySlug").alias("key"), "reason"))
    return out, rej


# ---------------------------------------------------------------------------------- K5
def load_flat_feed(wh: dict[str, DataFrame], flat: DataFrame, as_of) -> tuple[dict[str, DataFrame], dict]:
    """K5: normalise the flat feed, resolve the employer (name, else URL rule), seed the
    employer companies, insert-ignore jobs by (url, company), link offices for surviving jobs
    only, and report the skipped rows. A job without a url is the same as one loaded before if
    company and feed id are."""
    # feed order: numeric ids by value, others behind them by text
    number = F.expr("try_cast(id AS BIGINT)")
    norm = read_flat_jobs(flat.withColumn("_ord", F.struct(number.isNull().alias("text"), number.alias("number"),
                                                           F.col("id").cast("string").alias("id"))))
    resolved = J.resolve_employer(norm, "company", "url")
    skipped = resolved.filter(F.col("employer").isNull())
    ok = resolved.filter(F.col("employer").isNotNull())
    company = materialize(conform(H.ensure_seed_companies(wh["company"], SEED_EMPLOYERS), SC.COMPANY))
    # employers are of the seed list, so only companies of these names are looked up: a side that stays small
    employers = company.filter(F.col("name").isin(SEED_EMPLOYERS)).select("name", "id")
    staged = J.lookup(ok, employers, "employer", "name", "id", "companyId")
    ts = F.coalesce(F.col("date"), F.to_timestamp(F.lit(str(as_of) if not isinstance(as_of, _dt.datetime)
                                                          else as_of.isoformat(sep=" "))))
    jobs_src = staged.select(
        TX.surrogate_id("companyId", "url", "id").alias("id"), "title", "url", "companyId", ts.alias("timeStamp"),
        F.when(F.col("desc").isNotNull(), F.array(F.to_json(F.struct(F.col("desc").alias("description")))))
         .alias("skills"), F.col("desc").alias("description"), F.lit(FLAT_SOURCE).alias("dataSource"),
        F.lit(DEFAULT_COMPLETENESS).alias("dataCompleteness"), "location", "_ord")
    no_url = F.col("url").isNull()
    fresh = jobs_src.filter(~no_url).unionByName(
        jobs_src.filter(no_url).join(wh["job"].select("id"), "id", "left_anti").select(*jobs_src.columns))
    job = H.insert_ignore(wh["job"].withColumn("_ord", F.lit(None).cast(norm.schema["_ord"].dataType)),
                          conform(fresh, SC.JOB, ("_ord",)), ["url", "companyId"], ["_ord"])
    job = materialize(conform(job, SC.JOB))
    out = dict(wh)
    out["job"] = job
    locs = staged.filter(truthy(F.col("location"))).select(F.col("location").alias("name"), "companyId", "url")
    office = H.insert_ignore(wh["office"], build_dimension(locs, "name").withColumnRenamed("name", "location"),
                             ["location"], ["location"])
    out["office"] = office
    office_ids = office.select(F.col("location").alias("name"), F.col("id").alias("officeId"))
    out["company_office"] = _dedupe_union(wh["company_office"], locs.join(office_ids, "name"),
                                          ["companyId", "officeId"])
    surviving = jobs_src.join(job.select("id"), "id", "left_semi")
    out["job_office"] = _dedupe_union(
        wh["job_office"],
        surviving.filter(truthy(F.col("location"))).join(office_ids, F.col("location") == F.col("name"))
                 .select(F.col("id").alias("jobId"), "officeId"), ["jobId", "officeId"])
    out["company"] = conform(A.refresh_num_jobs(company, job, "id", "companyId"), SC.COMPANY)
    return out, A.skip_report(skipped)


# ---------------------------------------------------------------------------------- K6
def unify(wh: dict[str, DataFrame], portfolio: tuple[DataFrame, DataFrame] | None = None,
          flat: DataFrame | None = None, directory: tuple[DataFrame, DataFrame] | None = None,
          as_of=None, mode: str = "upsert") -> dict[str, DataFrame]:
    """K6: the portfolio, flat and directory feeds in that order; each later feed sees the
    rows of the earlier ones. The tables a feed has changed are written once, so the next feed's
    plans start from stored tables instead of the whole history."""
    if portfolio is not None:
        loaded, _ = load_portfolio(wh, portfolio[0], portfolio[1], mode)
        wh = materialize_changed(loaded, wh)
    if flat is not None:
        loaded, _ = load_flat_feed(wh, flat, as_of)
        wh = materialize_changed(loaded, wh)
    if directory is not None:
        loaded, _ = load_directory(wh, directory[0], directory[1])
        wh = materialize_changed(loaded, wh)
    return wh


# ---------------------------------------------------------------------------- commit / load
# Bucketing keys of the warehouse tables: the keys later loads join and upsert on.
BUCKET_KEYS = {
    "company": ["slug"], "market": ["name"], "stage": ["name"], "office": ["location"], "investor": ["slug"],
    "founder": ["id"], "company_market": ["companyId"], "company_stage": ["companyId"],
    "company_office": ["companyId"], "company_investor": ["companyId"], "company_founder": ["companyId"],
    "job": ["companyId"], "job_office": ["jobId"], "salary_range": ["jobId"],
}


def commit_warehouse(wh: dict[str, DataFrame], base: str, buckets: int) -> dict[str, int]:
    """Commit every table of a warehouse state as its next version, bucketed by its join key
    (``sources.sinks.commit_bucketed``); returns the version numbers."""
    from ..sources.sinks import commit_bucketed
    return {name: commit_bucketed(df, base, name, BUCKET_KEYS[name], buckets) for name, df in wh.items()}


def load_warehouse(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The current version of every warehouse table (empty typed tables where none exists)."""
    from ..sources.sinks import read_bucketed
    out = {}
    for name, schema in SC.WAREHOUSE.items():
        df = read_bucketed(spark, base, name)
        out[name] = df if df is not None else empty_frame(spark, schema)
    return out
