"""Staging relations of a portfolio load (A8), built from landed company / job rows.

Nothing is truncated or dropped: the eight relations are DataFrames of one plan; register
them as temp views if SQL access is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import or_null, to_flag, truthy
from ..functions.jsonish import json_text
from ..functions.parse import text_to_ts
from ..operators.flatten import flatten_links, flatten_locations, flatten_salaries, zip_parallel
from ..operators.validate import require_fields


def landing_place(landed: DataFrame) -> list[str]:
    """Columns that tell where a row was landed, most significant first, unique over all files of all sources:
    the source's rank, the path below its folder (else the full path, else the file name) and the position. Sources
    have files of one name as a rule, so the name alone is only right for rows that were read from one folder."""
    path = next((c for c in ("file_below", "file_path", "file_name") if c in landed.columns), None)
    return [c for c in ("source_rank", path, "line", "pos") if c is not None and c in landed.columns]


def stage_jobs(landed: DataFrame, *keep: str) -> DataFrame:
    """Landed job rows as they are staged, one for one, with their locations and salary; ``keep`` names further columns."""
    return landed.select(
        # the folder, not the rank: ids of jobs without a url come from it, and ranks change with the registry
        F.concat_ws(":", *["sourceFolder" if c == "source_rank" and "sourceFolder" in landed.columns else F.col(c).cast("string")
                           for c in landing_place(landed)]).alias("job_key"),
        F.struct(*landing_place(landed)).alias("_ord"), "title", F.col("companySlug").alias("company_slug"),
        or_null(F.col("url")).alias("url"), or_null(F.col("applyUrl")).alias("applyUrl"),
        *[to_flag(F.col(c), landed.schema[c].dataType).alias(c)
          for c in ["remote", "hybrid", "manager", "consultant", "contractor"]],
        text_to_ts(F.col("timeStamp")).alias("timeStamp"),
        *[F.when(F.col(c) != 0, F.col(c)).alias(c) for c in ["minYearsExp", "maxYearsExp"]],
        *[F.coalesce(F.col(c), F.array().cast("array<string>")).alias(c)
          for c in ["skills", "requiredSkills", "preferredSkills", "departments", "regions"]],
        *[F.when(F.col(c).isNotNull(), F.to_json(F.col(c))).alias(c) for c in ["jobTypes", "jobFunctions", "jobSeniorities"]],
        "locations", "normalizedLocations", "salary",
        (or_null(F.col("dataSource")) if "dataSource" in landed.columns else F.lit(None).cast("string")).alias("dataSource"), *keep)


def stage_portfolio(companies: DataFrame, jobs: DataFrame) -> dict[str, DataFrame]:
    """``companies`` / ``jobs``: landed rows (portfolio shapes) as ``read_source_tree`` returns them, at least
    with ``file_name`` and ``pos`` (and ``dataSource`` for companies). A job's key and the order of all rows are their
    landing place. Returns the staging relations, the landed rows of ``job`` (``landed_job``) and the rejects."""
    ok_c, rej_c = require_fields(companies, ["name", "slug"])
    comp = ok_c.select(
        "name", "slug", "description",
        F.coalesce(or_null(F.col("domain")), or_null(F.col("companyDomain"))).alias("domain"),
        F.coalesce(F.col("emailDomains"), F.array().cast("array<string>")).alias("emailDomains"),
        F.when(truthy(F.col("staffCount"), companies.schema["staffCount"].dataType), F.col("staffCount")).alias("staffCount"),
        F.coalesce(F.col("numJobs"), F.lit(0)).cast("long").alias("numJobs"),
        to_flag(F.col("isFeatured"), companies.schema["isFeatured"].dataType).alias("isFeatured"),
        to_flag(F.col("isRemoteFriendly"), companies.schema["isRemoteFriendly"].dataType).alias("isRemoteFriendly"),
        json_text(F.col("logos")).alias("logos"), json_text(F.col("website")).alias("website"),
        F.coalesce(F.col("parentSlugs"), F.array().cast("array<string>")).alias("parentSlugs"),
        F.coalesce(F.col("parents"), F.array().cast("array<string>")).alias("parents"),
        F.col("dataSource"), F.struct(*landing_place(companies)).alias("_ord"),
        "markets", "stages", "officeLocations", "investors", "investorSlugs")
    ok_j, rej_j = require_fields(jobs, ["title", "companySlug"])
    job = stage_jobs(ok_j)
    return {
        "company": comp.drop("markets", "stages", "officeLocations", "investors", "investorSlugs"),
        "market": flatten_links(comp, "slug", "markets").withColumnRenamed("slug", "company_slug"),
        "stage": flatten_links(comp, "slug", "stages").withColumnRenamed("slug", "company_slug"),
        "office": flatten_links(comp, "slug", "officeLocations").withColumnRenamed("slug", "company_slug"),
        "investor": zip_parallel(comp, "slug", "investors", "investorSlugs")
            .select(F.col("slug").alias("company_slug"), F.col("investor_name").alias("name"),
                    F.col("investor_slug").alias("slug"), "pos"),
        "landed_job": ok_j,
        "job": job.drop("locations", "normalizedLocations", "salary"),
        "job_location": flatten_locations(job, "job_key", "company_slug", "normalizedLocations", "locations"),
        "salary": flatten_salaries(job, "job_key"),
        "rejects": rej_c.select(F.lit("company").alias("kind"), F.col("slug").alias("key"), "reason")
            .unionByName(rej_j.select(F.lit("job").alias("kind"), F.col("companySlug").alias("key"), "reason")),
    }
