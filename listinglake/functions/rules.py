"""Ordered rule tables turned into first-match ``CASE`` expressions.

Rule tables here are short literal lists, so the first-match is a generated ``when`` chain over a text that is
lower-cased once — no join, nothing broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import _col

# The six seeded employers, and URL fragments that identify each one, checked in
# this order against the lower-cased URL.
SEED_EMPLOYERS = ["Amazon", "Apple", "Google", "Meta", "Microsoft", "Netflix"]
EMPLOYER_URL_RULES = [
    ("amazon.jobs", "Amazon"),
    ("jobs.careers.microsoft.com", "Microsoft"),
    ("careers.microsoft.com", "Microsoft"),
    ("jobs.netflix.com", "Netflix"),
    ("google.com", "Google"),
    ("careers.google.com", "Google"),
    ("apple.com/jobs", "Apple"),
    ("careers.apple.com", "Apple"),
    ("meta.com/careers", "Meta"),
    ("metacareers.com", "Meta"),
    ("facebook.com/careers", "Meta"),
    ("instagram.com/careers", "Meta"),
]

# Employer categories for the per-employer job count, checked in this order
# against the lower-cased company name; anything else is 'unknown'.
EMPLOYER_CATEGORY_RULES = [
    (("microsoft",), "microsoft"),
    (("apple",), "apple"),
    (("meta", "facebook"), "meta"),
    (("amazon",), "amazon"),
    (("netflix",), "netflix"),
    (("google", "alphabet"), "google"),
]
EMPLOYER_CATEGORIES = ["microsoft", "apple", "meta", "amazon", "netflix", "google", "unknown"]

# Status buckets (lower-cased, trimmed status; anything else is 'unknown').
STATUS_BUCKETS = ["active", "acquired", "inactive", "unknown"]


def _chain(s: Column, rules: list[tuple]) -> Column:
    """CASE over the needles in rule order."""
    out = None
    for needles, label in rules:
        for n in ((needles,) if isinstance(needles, str) else needles):
            out = F.when(s.contains(n), F.lit(label)) if out is None else out.when(s.contains(n), F.lit(label))
    return out


def first_contained(c, rules: list[tuple], default=None, lower: bool = True) -> Column:
    """First rule whose needle (or any of its needles) is contained in ``c`` wins.

    The lower-cased text is bound once (by a ``transform`` over an array of one) and the rules are a CASE over it, so
    neither the input expression nor ``lower`` is repeated per needle. Where a whole column is matched and then filtered
    on, ``with_first_contained`` does it in generated code."""
    s = F.lower(_col(c)) if lower else _col(c)
    hit = F.get(F.transform(F.array(s), lambda t: _chain(t, rules)), 0)
    return F.coalesce(hit, F.lit(default)) if default is not None else hit


def with_first_contained(df: DataFrame, name: str, c, rules: list[tuple], default=None, when: Column | None = None) -> DataFrame:
    """``df`` with the first matching rule's label (only where ``when`` holds, if given) as column ``name``.

    The lower-cased text is a column of its own below a generator of one row, and the CASE is what it generates: it is
    compiled, evaluated once per row, and neither the optimizer's merging of projections nor a filter on the label
    pushed downwards can bring it (or ``lower``) back a second time."""
    label = _chain(F.col("_lowered"), rules)
    if when is not None:
        label = F.when(F.col("_asked"), label)
    if default is not None:
        label = F.coalesce(label, F.lit(default))
    asked = [when.alias("_asked")] if when is not None else []
    return (df.select("*", F.lower(_col(c)).alias("_lowered"), *asked)
            .select("*", F.inline(F.array(F.struct(label.alias(name))))).drop("_lowered", "_asked"))


def employer_from_url(url) -> Column:
    """C11 with the employer URL table; NULL when nothing matches."""
    return first_contained(url, EMPLOYER_URL_RULES)


def employer_from_name(name) -> Column:
    """Exact case-insensitive employer name → canonical name (I14 first tier): a literal map
    lookup."""
    m = F.create_map(*[x for e in SEED_EMPLOYERS for x in (F.lit(e.lower()), F.lit(e))])
    return F.try_element_at(m, F.lower(_col(name)))


def employer_category(name) -> Column:
    """D6 category of a company name: falsy names count as 'unknown'."""
    n = _col(name)
    return F.when(n.isNull() | (n == F.lit("")), F.lit("unknown")) \
        .otherwise(first_contained(n, EMPLOYER_CATEGORY_RULES, default="unknown"))


def status_bucket(status) -> Column:
    """lower+trim status (missing → 'unknown') into the four buckets."""
    s = F.lower(F.trim(F.coalesce(F.when(_col(status) != F.lit(""), _col(status)), F.lit("Unknown"))))
    return F.when(s.isin(*STATUS_BUCKETS[:3]), s).otherwise(F.lit("unknown"))
