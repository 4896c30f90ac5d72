"""Joins (C1–C6, C8, C10–C12).

Join sides derived from data are never hinted for broadcast: their size grows with the input,
so the choice is left to AQE, which switches to a broadcast only after measuring the shuffled
side at runtime (``spark.sql.adaptive.autoBroadcastJoinThreshold``) and otherwise keeps a
sort-merge join whose skewed partitions it splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import spread, with_null_safe_keys
from ..functions.core import truthy
from ..functions.rules import EMPLOYER_URL_RULES, employer_from_name, with_first_contained


def link(staged: DataFrame, dim: DataFrame, company: DataFrame, staged_name: str = "name",
         staged_company: str = "company_slug", dim_name: str = "name", dim_id: str = "id",
         company_key: str = "slug", company_id: str = "id",
         out: tuple[str, str] = ("companyId", "dimId")) -> DataFrame:
    """staged(name, company) ⋈ dim(name) ⋈ company(key) → unique id pairs (H8)."""
    d = dim.select(F.col(dim_name).alias("_dn"), F.col(dim_id).alias(out[1]))
    c = company.select(F.col(company_key).alias("_ck"), F.col(company_id).alias(out[0]))
    pairs = (staged.select(F.col(staged_name).alias("_sn"), F.col(staged_company).alias("_sc"))
                   .join(d, F.col("_sn") == F.col("_dn"))
                   .join(c, F.col("_sc") == F.col("_ck"))
                   .select(out[0], out[1]))
    return pairs.dropDuplicates([out[0], out[1]])


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, dim_id: str, out: str) -> DataFrame:
    """Probe a name → id dimension; misses dropped."""
    d = dim.select(F.col(dim_key).alias("_lk"), F.col(dim_id).alias(out))
    return df.join(d, F.col(key) == F.col("_lk")).drop("_lk")


def attach_company(jobs: DataFrame, company: DataFrame, job_key: str = "company_slug",
                   company_key: str = "slug", company_id: str = "id", out: str = "companyId") -> DataFrame:
    """Inner join on the company key; jobs without a company drop out."""
    c = company.select(F.col(company_key).alias("_ck"), F.col(company_id).alias(out))
    return jobs.join(c, F.col(job_key) == F.col("_ck")).drop("_ck")


def enrich_left(base: DataFrame, details: DataFrame, jobs: DataFrame, key: str = "slug",
                overrides: dict[str, str] | None = None) -> DataFrame:
    """Base ⟕ details ⟕ jobs on ``key``. ``overrides`` maps output column → (details
    column, base column) pairs given as ``{"out": ("d_col", "b_col")}``; the details value wins
    when truthy. ``founders`` defaults to [] and ``jobCount`` to 0 when the frames carry them."""
    d = details.alias("d")
    j = jobs.alias("j")
    out = base.alias("b").join(d, F.col(f"b.{key}") == F.col(f"d.{key}"), "left") \
        .join(j, F.col(f"b.{key}") == F.col(f"j.{key}"), "left")
    overrides = overrides or {}
    replaced = {bc for name, (dc, bc) in overrides.items() if name == bc}
    cols = [F.col(f"b.{c}") for c in base.columns if c not in replaced]
    for name, (dc, bc) in overrides.items():
        dtype = details.schema[dc].dataType
        cols.append(F.when(truthy(F.col(f"d.{dc}"), dtype), F.col(f"d.{dc}")).otherwise(F.col(f"b.{bc}")).alias(name))
    extra_d = [c for c in details.columns if c != key and c not in {v[0] for v in overrides.values()}]
    for c in extra_d:
        if c == "founders":
            cols.append(F.coalesce(F.col("d.founders"), F.array()).alias("founders"))
        elif c == "jobCount":
            cols.append(F.coalesce(F.col("d.jobCount"), F.lit(0)).alias("jobCount"))
        else:
            cols.append(F.col(f"d.{c}").alias(c))
    for c in jobs.columns:
        if c != key:
            cols.append(F.col(f"j.{c}").alias(c))
    return out.select(*cols)


def new_jobs(staged: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """C4: staged rows with no existing row on ``keys`` (anti join)."""
    return staged.join(spread(existing.select(*keys).distinct()), keys, "left_anti")


def match_existing(staged: DataFrame, existing: DataFrame, keys: list[str], id_col: str = "id",
                   out: str = "existing_id") -> DataFrame:
    """Staged rows matched to existing ids on ``keys`` (existing side one row per key)."""
    e = existing.groupBy(*keys).agg(F.min(id_col).alias(out))
    return staged.join(spread(e), keys)


def two_tier_match(staged: DataFrame, existing: DataFrame, company: str = "companyId", url: str = "url",
                   title: str = "title", id_col: str = "id", out: str = "matched_id") -> DataFrame:
    """Match on (url, company) when the staged url is truthy, else on (title, company);
    the url tier wins. Each existing side is first reduced to one id per key (the lowest), so
    both joins are many-to-one — no fan-out, no cap on candidates, and no OR join condition
    (which would lose hash/sort-merge planning)."""
    by_url = (existing.filter(truthy(F.col(url)))
                      .groupBy(F.col(company).alias("_uc"), F.col(url).alias("_uu"))
                      .agg(F.min(id_col).alias("_uid")))
    by_title = (existing.groupBy(F.col(company).alias("_tc"), F.col(title).alias("_tt"))
                        .agg(F.min(id_col).alias("_tid")))
    s = staged.withColumn("_has_url", truthy(F.col(url)))
    j = (s.join(spread(by_url), (F.col(company) == F.col("_uc")) & (F.col(url) == F.col("_uu")) & F.col("_has_url"), "left")
          .join(spread(by_title), (F.col(company) == F.col("_tc")) & (F.col(title) == F.col("_tt")), "left"))
    return (j.withColumn(out, F.when(F.col("_uid").isNotNull(), F.col("_uid")).otherwise(F.col("_tid")))
             .withColumn("match_tier", F.when(F.col("_uid").isNotNull(), F.lit(1))
                                        .when(F.col("_tid").isNotNull(), F.lit(2)))
             .drop("_uc", "_uu", "_uid", "_tc", "_tt", "_tid", "_has_url"))


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children with no parent (NULL-safe key equality: a missing key matches a parent
    with a missing key)."""
    p, pk = with_null_safe_keys(parents.select(F.col(parent_key).alias("_pk")), ["_pk"], "_ok", always=True)
    c, ck = with_null_safe_keys(children, [child_key], "_ok", always=True)
    return c.join(spread(p.select(*pk).distinct()), ck, "left_anti").drop(*[x for x in ck if x.startswith("_ok")])


def childless(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Parents with no child (NULL-safe key equality)."""
    return orphans(parents, children, parent_key, child_key)


# Match-source labels and the two skip reasons of the employer resolution.
MATCH_BY_NAME = "company_name"
MATCH_BY_URL = "url_pattern"
REASON_NO_NAME = "No company name"
REASON_NO_MATCH = "Company not in FAANG list and URL not matching"


def resolve_employer(df: DataFrame, company: str = "company", url: str = "url") -> DataFrame:
    """I14 + C11: exact case-insensitive employer name, else (when the url is truthy) the first
    URL rule, else a skip reason that depends only on whether a company name was given.
    Adds ``employer``, ``match_source`` and ``reject_reason``."""
    named = df.withColumn("_by_name", employer_from_name(F.col(company)))
    # resolved once, before any filter on the result: rows with a name are not matched against the url rules at all
    found = with_first_contained(named, "_by_url", F.col(url), EMPLOYER_URL_RULES, when=F.col("_by_name").isNull() & truthy(F.col(url)))
    return (found.withColumn("employer", F.coalesce("_by_name", "_by_url"))
              .withColumn("match_source", F.when(F.col("_by_name").isNotNull(), F.lit(MATCH_BY_NAME))
                                           .when(F.col("_by_url").isNotNull(), F.lit(MATCH_BY_URL)))
              .drop("_by_name", "_by_url")
              .withColumn("reject_reason",
                          F.when(F.col("employer").isNotNull(), F.lit(None).cast("string"))
                           .when(~truthy(F.col(company)), F.lit(REASON_NO_NAME))
                           .otherwise(F.lit(REASON_NO_MATCH))))


def rewire_bridge(bridge: DataFrame, mapping: DataFrame, id_col: str, other_col: str,
                  old: str = "old_id", new: str = "new_id") -> DataFrame:
    """Repoint ``id_col`` of merged ids at their survivor, without duplicate links."""
    m = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    out = (bridge.join(m, F.col(id_col) == F.col("_old"), "left")
                 .withColumn(id_col, F.coalesce(F.col("_new"), F.col(id_col)))
                 .drop("_old", "_new"))
    return out.dropDuplicates([id_col, other_col])
