"""Array / nested flattening (J1–J5). All are generators (``explode`` / ``posexplode``) that
run inside the scan's stage — no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import truthy
from ..functions.jsonish import unwrap_label, unwrap_value
from ..functions.text import founder_id


def flatten_links(companies: DataFrame, parent_key: str, array_col: str, field: str | None = None,
                  out: str = "name") -> DataFrame:
    """One (parent, name) row per truthy array element; ``field`` picks the name out of
    struct elements ({name} / {location} forms)."""
    arr = F.col(array_col)
    elem_type = companies.schema[array_col].dataType.elementType
    if isinstance(elem_type, T.StructType):
        arr = F.transform(arr, lambda e: e[field or "name"])
    return (companies.select(F.col(parent_key), F.explode(F.filter(arr, lambda x: truthy(x))).alias(out)))


def flatten_jobs(companies: DataFrame, postings: str, parent_cols: dict[str, str],
                 name_col: str | None = None, name_default: str = "N/A") -> DataFrame:
    """One row per posting carrying parent columns (``{out: parent_col}``) and the
    posting's 1-based position; the parent name defaults to 'N/A'."""
    cols = []
    for out, src in parent_cols.items():
        c = F.col(src)
        if name_col is not None and src == name_col:
            c = F.when(truthy(c), c).otherwise(F.lit(name_default))
        cols.append(c.alias(out))
    exploded = companies.select(*cols, F.posexplode(F.col(postings)).alias("_pos", "_job"))
    return exploded.select(*parent_cols.keys(), (F.col("_pos") + 1).alias("posting_pos"), "_job.*")


def drop_nested(df: DataFrame, array_col: str, count_col: str) -> DataFrame:
    """Keep the element count, drop the nested array."""
    a = F.col(array_col)
    return df.withColumn(count_col, F.when(a.isNotNull(), F.size(a)).otherwise(F.lit(0))).drop(array_col)


def flatten_founders(companies: DataFrame, parent_key: str, founders: str = "founders",
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per founder with the deterministic founder id (I7) and the founder's place in the
    company (``pos``, from 1). Founder structs carry ``name, title, bio`` and ``social_links`` (map);
    ``carry`` names further company columns to keep."""
    f = companies.select(F.col(parent_key), *carry, F.posexplode(F.col(founders)).alias("_p", "f"))
    links = F.col("f.social_links")
    return f.select(
        F.col(parent_key), *carry, (F.col("_p") + 1).alias("pos"),
        founder_id(F.col("f.name"), links["linkedin"], links["twitter"], F.col("f.bio")).alias("id"),
        F.col("f.name").alias("name"),
        F.when(truthy(F.col("f.title")), F.col("f.title")).alias("title"),
        F.when(truthy(F.col("f.bio")), F.col("f.bio")).alias("bio"),
        F.when(truthy(links["twitter"]), links["twitter"]).alias("twitter"),
        F.when(truthy(links["linkedin"]), links["linkedin"]).alias("linkedin"),
        F.lit(None).cast("string").alias("website"))


def flatten_locations(jobs: DataFrame, ordinal: str, company: str, preferred: str, fallback: str) -> DataFrame:
    """J5 (locations): one row per truthy location of a job; the preferred array (normalised
    locations) is used when present, else the fallback. Elements are JSON text or strings."""
    arr = F.coalesce(F.col(preferred), F.col(fallback), F.array().cast("array<string>"))
    return (jobs.select(F.col(ordinal).alias("job_ordinal"), F.col(company).alias("company_slug"),
                        F.explode(arr).alias("_loc"))
                .select("job_ordinal", "company_slug", unwrap_label(F.col("_loc")).alias("location_name"))
                .filter(F.col("location_name").isNotNull()))


def flatten_salaries(jobs: DataFrame, ordinal: str, salary: str = "salary") -> DataFrame:
    """J5 (salary): at most one salary row per job. Bounds are parsed as doubles (falsy → NULL);
    currency / period may be a string or a {value, label} object (value first)."""
    s = F.col(salary)
    def bound(name):
        v = s[name].cast("string")
        return F.when(truthy(v) & (v != F.lit("0")), v).try_cast("double")
    return (jobs.filter(s.isNotNull())
                .select(F.col(ordinal).alias("job_ordinal"),
                        bound("minValue").alias("min_value"), bound("maxValue").alias("max_value"),
                        unwrap_value(s["currency"].cast("string")).alias("currency"),
                        unwrap_value(s["period"].cast("string")).alias("period")))


def zip_parallel(df: DataFrame, parent_key: str, names: str, slugs: str) -> DataFrame:
    """Pair name i with slug i; where the slug array is shorter the slug falls back to
    lower(name) with runs of non-alphanumerics replaced by '-' (no trimming, no cap).
    Falsy names are skipped; the 1-based position is kept."""
    from ..functions.text import slugify
    ex = df.select(F.col(parent_key), F.col(slugs).alias("_slugs"), F.posexplode(F.col(names)).alias("_p", "_name"))
    given = F.try_element_at(F.col("_slugs"), (F.col("_p") + 1).cast("int"))
    return (ex.filter(truthy(F.col("_name")))
              .select(F.col(parent_key), (F.col("_p") + 1).alias("pos"), F.col("_name").alias("investor_name"),
                      F.coalesce(given, slugify(F.col("_name"), trim_dashes=False, max_len=None)).alias("investor_slug")))
