"""Explicit schemas: warehouse tables and landed record shapes (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType()
AS = T.ArrayType(T.StringType())


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# ---- warehouse -------------------------------------------------------------------------
COMPANY = struct(("id", S), ("name", S), ("description", S), ("domain", S), ("emailDomains", AS),
                 ("staffCount", I), ("numJobs", L), ("slug", S), ("isFeatured", B), ("isRemoteFriendly", B),
                 ("logos", S), ("website", S), ("parentSlugs", AS), ("parents", AS), ("batchInfo", S),
                 ("dataSource", S), ("foundedAt", TS), ("oneLiner", S), ("status", S))
MARKET = struct(("id", S), ("name", S))
STAGE = struct(("id", S), ("name", S))
OFFICE = struct(("id", S), ("location", S))
INVESTOR = struct(("id", S), ("name", S), ("slug", S))
FOUNDER = struct(("id", S), ("name", S), ("title", S), ("bio", S), ("twitter", S), ("linkedin", S), ("website", S))
COMPANY_MARKET = struct(("companyId", S), ("marketId", S))
COMPANY_STAGE = struct(("companyId", S), ("stageId", S))
COMPANY_OFFICE = struct(("companyId", S), ("officeId", S))
COMPANY_INVESTOR = struct(("companyId", S), ("investorId", S))
COMPANY_FOUNDER = struct(("companyId", S), ("founderId", S))
JOB = struct(("id", S), ("title", S), ("applyUrl", S), ("url", S), ("companyId", S), ("remote", B), ("hybrid", B),
             ("timeStamp", TS), ("manager", B), ("consultant", B), ("contractor", B), ("minYearsExp", I),
             ("maxYearsExp", I), ("skills", AS), ("requiredSkills", AS), ("preferredSkills", AS),
             ("departments", AS), ("jobTypes", S), ("jobFunctions", S), ("jobSeniorities", S), ("regions", AS),
             ("dataCompleteness", S), ("dataSource", S), ("description", S), ("equityRange", S),
             ("roleSpecificType", S))
JOB_OFFICE = struct(("jobId", S), ("officeId", S))
SALARY_RANGE = struct(("id", S), ("jobId", S), ("minValue", D), ("maxValue", D), ("currency", S), ("period", S))

WAREHOUSE = {
    "company": COMPANY, "market": MARKET, "stage": STAGE, "office": OFFICE, "investor": INVESTOR,
    "founder": FOUNDER, "company_market": COMPANY_MARKET, "company_stage": COMPANY_STAGE,
    "company_office": COMPANY_OFFICE, "company_investor": COMPANY_INVESTOR, "company_founder": COMPANY_FOUNDER,
    "job": JOB, "job_office": JOB_OFFICE, "salary_range": SALARY_RANGE,
}

# The warehouse's rules. Required columns, unique keys (primary keys first) and foreign keys
# (column → table and its key).
REQUIRED = {
    "company": ["id", "name", "numJobs", "slug", "isFeatured", "isRemoteFriendly"],
    "market": ["id", "name"], "stage": ["id", "name"], "office": ["id", "location"],
    "investor": ["id", "name", "slug"], "founder": ["id", "name"],
    "company_market": ["companyId", "marketId"], "company_stage": ["companyId", "stageId"],
    "company_office": ["companyId", "officeId"], "company_investor": ["companyId", "investorId"],
    "company_founder": ["companyId", "founderId"],
    "job": ["id", "title", "companyId", "remote", "hybrid", "manager", "consultant", "contractor", "dataCompleteness"],
    "job_office": ["jobId", "officeId"], "salary_range": ["id", "jobId"],
}
UNIQUE = {
    "company": [["id"], ["slug"]], "market": [["id"], ["name"]], "stage": [["id"], ["name"]],
    "office": [["id"], ["location"]], "investor": [["id"], ["name"], ["slug"]], "founder": [["id"], ["name", "linkedin"]],
    "company_market": [["companyId", "marketId"]], "company_stage": [["companyId", "stageId"]],
    "company_office": [["companyId", "officeId"]], "company_investor": [["companyId", "investorId"]],
    "company_founder": [["companyId", "founderId"]], "job": [["id"], ["url", "companyId"]],
    "job_office": [["jobId", "officeId"]], "salary_range": [["id"], ["jobId"]],
}
FOREIGN = {
    "company_market": {"companyId": ("company", "id"), "marketId": ("market", "id")},
    "company_stage": {"companyId": ("company", "id"), "stageId": ("stage", "id")},
    "company_office": {"companyId": ("company", "id"), "officeId": ("office", "id")},
    "company_investor": {"companyId": ("company", "id"), "investorId": ("investor", "id")},
    "company_founder": {"companyId": ("company", "id"), "founderId": ("founder", "id")},
    "job": {"companyId": ("company", "id")},
    "job_office": {"jobId": ("job", "id"), "officeId": ("office", "id")},
    "salary_range": {"jobId": ("job", "id")},
}

# ---- landed shapes ---------------------------------------------------------------------
PORTFOLIO_COMPANY = struct(
    ("name", S), ("slug", S), ("id", S), ("description", S), ("domain", S), ("companyDomain", S),
    ("emailDomains", AS), ("staffCount", I), ("numJobs", L), ("markets", AS), ("stages", AS),
    ("officeLocations", AS), ("investors", AS), ("investorSlugs", AS), ("logos", S), ("website", S),
    ("isFeatured", B), ("isRemoteFriendly", B), ("parentSlugs", AS), ("parents", AS))

SALARY = struct(("minValue", S), ("maxValue", S), ("currency", S), ("period", S))
PORTFOLIO_JOB = struct(
    ("title", S), ("companySlug", S), ("companyDomain", S), ("url", S), ("applyUrl", S), ("remote", B),
    ("hybrid", B), ("manager", B), ("consultant", B), ("contractor", B), ("timeStamp", S),
    ("minYearsExp", I), ("maxYearsExp", I), ("skills", AS), ("requiredSkills", AS), ("preferredSkills", AS),
    ("jobTypes", AS), ("jobFunctions", AS), ("jobSeniorities", AS), ("regions", AS), ("departments", AS),
    ("locations", AS), ("normalizedLocations", AS), ("salary", SALARY), ("dataSource", S))

FOUNDER_IN = struct(("name", S), ("title", S), ("bio", S), ("social_links", T.MapType(S, S)))
POSTING = struct(("title", S), ("url", S), ("applyUrl", S), ("companyUrl", S), ("type", S), ("role", S),
                 ("roleSpecificType", S), ("location", S), ("createdAt", S), ("minExperience", S),
                 ("salaryRange", S), ("equityRange", S))
DIRECTORY_BASE = struct(
    ("slug", S), ("name", S), ("batch", S), ("website", S), ("long_description", S), ("one_liner", S),
    ("team_size", I), ("all_locations", S), ("status", S), ("stage", S), ("launched_at", L), ("top_company", B),
    ("small_logo_thumb_url", S), ("industries", AS), ("tags", AS), ("regions", AS))
DIRECTORY_DETAILS = struct(
    ("slug", S), ("name", S), ("batch", S), ("status", S), ("website", S), ("teamSize", I), ("location", S),
    ("description", S), ("tags", AS), ("jobCount", I), ("founders", T.ArrayType(FOUNDER_IN)),
    ("social_links", T.MapType(S, S)))
DIRECTORY_JOBS = struct(("slug", S), ("status", S), ("jobPostings", T.ArrayType(POSTING)),
                        ("socialLinks", T.MapType(S, S)))
FLAT_JOB = struct(("id", S), ("title", S), ("desc", S), ("date", S), ("location", S), ("url", S), ("company", S))
