"""Merge / upsert / integrity.

Parquet tables have no MERGE here, so every operator returns the *new full state* of the
target as a DataFrame; committing it is a write to a new version folder (``sources.sinks``).
Keys are unique on both sides after the batch is collapsed, so the full-outer / anti joins
below are one-to-one on the key and shuffle each side once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import truthy
from ..functions.text import surrogate_id
from ..sources.literals import known_empty, literal_frame
from .dedupe import first_wins, last_wins
from .keys import spread


def _all_not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def collapse_batch(src: DataFrame, keys: list[str], order: list) -> DataFrame:
    """H1, inside the batch: the first row per key (under ``order``) wins. NULL-key rows get their own ordering value as
    an extra window key, so each forms a group of one."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    tagged = src.withColumn("_nk", F.when(~_all_not_null(keys), F.struct(*order_cols)))
    return first_wins(tagged, keys + ["_nk"], order).drop("_nk")


def insert_ignore(target: DataFrame, src: DataFrame, keys: list[str], order: list, collapsed: bool = False) -> DataFrame:
    """H1: existing rows win; inside the batch the first row (under ``order``, which must end
    in a unique column) wins; a row with any NULL key part never conflicts (unique indexes
    treat NULLs as distinct), so it is always inserted.

    One pass over the batch (``collapse_batch``; none if it is ``collapsed`` already); NULL-key rows also fall through the
    anti join because NULL never equals anything."""
    nn = _all_not_null(keys)
    batch = src if collapsed else collapse_batch(src, keys, order)
    fresh = batch.join(target.select(*keys).filter(nn).distinct(), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def upsert(target: DataFrame, src: DataFrame, key: str, replace: list[str], ordinal: str | None = None,
           keep: list[str] | None = None) -> DataFrame:
    """H2/H3: by ``key``: matched rows take the batch values of ``replace`` columns and keep
    their own values of every other column (``keep`` lists ones that must never change, e.g.
    id and counters); unmatched batch rows are inserted as they are. With several batch rows
    per key the last ``ordinal`` wins. A NULL key never conflicts (H1): each such batch row is inserted
    as it is, and such target rows stay."""
    if ordinal:
        own = F.when(F.col(key).isNull(), F.col(ordinal))
        s = last_wins(src.withColumn("_nk", own), [key, "_nk"], [ordinal]).drop("_nk")
    else:
        s = src
    if known_empty(target):  # every row is new; without a join they also stay dealt out as they are
        return s.select(*[F.col(c) if c in s.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = s.withColumn("_in_s", F.lit(True)).alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    # which side a row has is told by a mark, not by its key, which may be NULL
    matched_s = F.col("s._in_s").isNotNull()
    in_t = F.col("t._in_t").isNotNull()
    keep = set(keep or [])
    cols = []
    for c in target.columns:
        if c == key:
            cols.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif c in replace and c not in keep and c in src.columns:
            cols.append(F.when(matched_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in src.columns:
            cols.append(F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        else:
            cols.append(F.col(f"t.{c}").alias(c))
    return j.select(*cols)


def upsert_dimension_checked(target: DataFrame, src: DataFrame, key: str, name: str, ordinal: str,
                             replace: list[str], keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """H3: last-wins per key, then upsert; a batch row whose name already belongs to another key
    (unique name) is rejected instead of raising. Of several batch rows with one name the first
    ``ordinal`` has it and the others are rejected; missing names never clash."""
    s = last_wins(src, key, [ordinal])
    owners = target.select(F.col(key).alias("_ok"), F.col(name).alias("_on"))
    clash_cond = (F.col(name) == F.col("_on")) & (F.col(key) != F.col("_ok"))
    free = s.join(owners, clash_cond, "left_anti")
    # the smallest (ordinal, key) of a name comes from a partial aggregate, so a name that a third of the batch
    # shares is neither sorted nor gathered in one task; the join back is many-to-one and can be split
    place = F.struct(F.col(ordinal).alias("o"), F.col(key).alias("k"))
    holders = free.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("_hn")).agg(F.min(place).alias("_first"))
    ranked = free.join(spread(holders), F.col(name) == F.col("_hn"), "left")
    holds = F.col(name).isNull() | (place == F.col("_first"))
    ok = ranked.filter(holds).select(*s.columns)
    rejects = (s.join(owners, clash_cond, "left_semi").unionByName(ranked.filter(~holds).select(*s.columns))
               .withColumn("reason", F.lit(f"{name} already used")))
    return upsert(target, ok, key, replace, keep=keep), rejects


def collapse_batch_jobs(staged: DataFrame, company: str, url: str, title: str, ordinal: str) -> DataFrame:
    """Directory-feed batch collapse: last ordinal wins per (company, truthy url), then per (company, title)."""
    has_url = truthy(F.col(url))
    with_url = last_wins(staged.filter(has_url), [company, url], [ordinal])
    step1 = with_url.unionByName(staged.filter(~has_url))
    return last_wins(step1, [company, title], [ordinal])


def _key_rows(df: DataFrame, company: str, url: str | None, title: str | None, id_value: Column, *carry: Column | str) -> DataFrame:
    """One narrow row (hash, kind, company, value) for every key of a job that is given and not missing. The hash leads
    the others in a join, so that they are compared only where it is equal."""
    def key(kind, c, value, there):
        return F.when(there, F.struct(F.lit(kind).alias("kind"), c.alias("company"), value.cast("string").alias("value")))
    c, known = F.col(company).cast("string"), F.col(company).isNotNull()
    keys = [key("id", F.lit(""), id_value, id_value.isNotNull())]
    if url:
        keys.append(key("url", c, F.col(url), known & truthy(F.col(url))))
    if title:
        keys.append(key("title", c, F.col(title), known & F.col(title).isNotNull()))
    return (df.select(*carry, F.explode(F.array_compact(F.array(*keys))).alias("_k"))
            .select("*", F.xxhash64("_k.kind", "_k.company", "_k.value").alias("hash"), "_k.*").drop("_k"))


def upsert_jobs(target: DataFrame, staged: DataFrame, mode: str = "title", company: str = "companyId",
                url: str = "url", title: str = "title", id_col: str = "id", ordinal: str = "ordinal",
                replace: list[str] | None = None, collapsed: bool = False) -> DataFrame:
    """H4: ``mode='title'`` — update every existing job with the same (title, company) with the
    last staged row for that key, insert the rest; ``mode='two_tier'`` — collapse the batch,
    match by (url, company) then (title, company) (C6), update the matched job, insert the rest.
    New jobs get ``id = sha256(company::url::title)``; where an older job holds that id already (it
    was renamed since), the hash of that id and of the company's number of jobs, which grows with every insert.

    ``collapsed``: the batch has one row per company and title already.

    The target is shuffled twice: once as narrow key rows, among which the batch looks up matches and held ids in one
    join (its side has each key once), and once as it is, to take the matched rows' new values. A count of jobs per company,
    combined map-side, is made beside that for ids that are held; everything else has the batch's size."""
    replace = replace or [c for c in staged.columns if c in target.columns and c not in (id_col, company)]
    two_tier = mode == "two_tier"
    if mode not in ("title", "two_tier"):
        raise ValueError(f"unknown mode {mode!r}")
    if collapsed:
        s = staged
    else:
        s = collapse_batch_jobs(staged, company, url, title, ordinal) if two_tier else last_wins(staged, [company, title], [ordinal])
    # after the collapse a staged row is known by company and title (a missing one included)
    s = s.drop(id_col).withColumn("_row", F.struct(F.col(company).alias("c"), F.col(title).alias("t")))
    s = s.withColumn("_new", surrogate_id(company, url, title))
    known = _key_rows(target, company, url if two_tier else None, title, F.col(id_col), F.col(id_col).alias("_found"))
    asked = _key_rows(s, company, url if two_tier else None, title, F.col("_new"), "_row")
    by_kind = {k: F.min(F.when(F.col("kind") == k, F.col("_found"))) for k in ("url", "title", "id")}
    answers = (asked.join(known, ["hash", "kind", "company", "value"]).groupBy("_row")
               .agg(F.coalesce(by_kind["url"], by_kind["title"]).alias("_mid"), by_kind["id"].isNotNull().alias("_held")))
    m = s.join(answers, "_row", "left").drop("_row")
    t = target.alias("t")
    if two_tier:
        # several staged rows may hit one existing job: the last ordinal wins
        h = last_wins(m.filter(F.col("_mid").isNotNull()), "_mid", [ordinal]).alias("s")
        j = t.join(h, F.col(f"t.{id_col}") == F.col("s._mid"), "left")
    else:
        h = m.filter(F.col("_mid").isNotNull()).alias("s")
        j = t.join(h, (F.col(f"t.{company}") == F.col(f"s.{company}")) & (F.col(f"t.{title}") == F.col(f"s.{title}")), "left")
    hit = F.col("s._mid").isNotNull()
    updated = j.select(*[(F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in replace
                          else F.col(f"t.{c}")).alias(c) for c in target.columns])
    inserts = m.filter(F.col("_mid").isNull())
    held = F.coalesce(F.col("_held"), F.lit(False))
    sizes = target.groupBy(F.col(company).alias("_c")).agg(F.count(F.lit(1)).alias("_rows"))
    new = inserts.join(spread(sizes), (F.col(company) == F.col("_c")) & held, "left").withColumn(
        id_col, F.when(held, surrogate_id("_new", "_rows")).otherwise(F.col("_new")))
    return updated.unionByName(new.select(*[
        F.col(c) if c in new.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns]))


def unheld_ids(rows: DataFrame, target: DataFrame, company: str, id_col: str = "id") -> DataFrame:
    """New rows whose id an older row holds already get another one: the hash of that id and of the
    company's number of rows, which grows with every insert."""
    held = target.select(F.col(id_col).alias("_held"))
    marked = rows.join(held, F.col(id_col) == F.col("_held"), "left")
    sizes = target.groupBy(F.col(company).alias("_company")).agg(F.count(F.lit(1)).alias("_rows"))
    again = (marked.filter(F.col("_held").isNotNull()).join(spread(sizes), F.col(company) == F.col("_company"))
             .withColumn(id_col, surrogate_id(id_col, "_rows")))
    return marked.filter(F.col("_held").isNull()).select(*rows.columns).unionByName(again.select(*rows.columns))


def upsert_salary(target: DataFrame, src: DataFrame, job_key: str = "jobId", min_col: str = "minValue",
                  new_id: Column | None = None) -> DataFrame:
    """H5: one range per job — the batch keeps the largest minimum (NULL first, as PostgreSQL's
    DESC orders), then overwrites the job's existing range. ``new_id``: a new range's id where the batch has none, made
    after the batch has moved."""
    order = [F.col(min_col).desc_nulls_first()] + [F.col(c).asc_nulls_last() for c in src.columns if c != min_col]
    s = first_wins(src, job_key, order)
    if new_id is not None:
        s = s.withColumn("id", new_id)
    return upsert(target, s, job_key, [c for c in target.columns if c not in (job_key, "id")], keep=["id"])


def replace_links(bridge: DataFrame, touched: DataFrame, new_links: DataFrame, key: str, by_key: bool = False) -> DataFrame:
    """H6: drop every link of a re-imported parent, add the new links, unique pairs. ``by_key``, for parents of few links:
    they are dealt out by the parent alone, so a later join with it does not move them again."""
    kept = bridge.join(touched.select(key).distinct(), key, "left_anti")
    links = kept.unionByName(new_links.select(*bridge.columns))
    return (links.repartition(key) if by_key else links).distinct()


def ensure_seed_companies(target: DataFrame, names: list[str], name_col: str = "name") -> DataFrame:
    """H7: insert the named companies that are missing (matched by name); slug = lower(name),
    description = '<name> job listings'. The seed list is a fixed literal table."""
    spark = target.sparkSession
    seeds = literal_frame(spark, [(n,) for n in names], f"{name_col} string")
    seeds = (seeds.withColumn("slug", F.lower(F.col(name_col)))
                  .withColumn("description", F.concat(F.col(name_col), F.lit(" job listings")))
                  .withColumn("id", surrogate_id("slug")))
    for c in target.columns:
        if c not in seeds.columns:
            seeds = seeds.withColumn(c, F.lit(None).cast(target.schema[c].dataType))
    # the seed side is the fixed literal list; the target side is never broadcast
    missing = seeds.join(target.select(F.col(name_col).alias("_n")), F.col(name_col) == F.col("_n"), "left_anti")
    return target.unionByName(missing.select(*target.columns))


def dedupe_bridge(links: DataFrame, left: str, right: str) -> DataFrame:
    """H8: one row per (left, right) pair."""
    return links.dropDuplicates([left, right])


def bridge_dedupe_report(links: DataFrame, left: str, right: str) -> DataFrame:
    """H8 report: total, unique and removed link counts in one row."""
    per = links.groupBy(left, right).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total"),
                   F.count(F.lit(1)).cast("long").alias("unique")) \
        .withColumn("removed", F.col("total") - F.col("unique"))
