"""Parsing enrichments (I3, I4, I5, I6, I8, I10, I12). Built-in expressions only."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import _col, truthy

# Seniority keywords, checked in this order; the first one contained in the
# lower-cased title gives the label.
SENIORITY_RULES = [
    ("junior", "JUNIOR"),
    ("entry", "ENTRY"),
    ("senior", "SENIOR"),
    ("lead", "LEAD"),
    ("staff", "SENIOR"),
    ("principal", "LEAD"),
    ("director", "EXECUTIVE"),
    ("vp", "EXECUTIVE"),
    ("head", "EXECUTIVE"),
]
DEFAULT_SENIORITY = "MID"

# Currency symbols recognised in salary text, and the fallback currency.
CURRENCY_SYMBOLS = "$€£¥"
DEFAULT_CURRENCY = "USD"
DEFAULT_PERIOD = "yearly"


def _as_ts(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else as_of.isoformat()
    return F.to_timestamp(F.lit(str(as_of)))


def _months_back(ts: Column, n: Column) -> Column:
    """Calendar-month subtraction with day overflow into the next month (03-31 − 1 month →
    03-02), keeping the time of day."""
    d = F.to_date(ts)
    shifted = F.date_add(F.add_months(F.trunc(d, "MM"), -n), F.dayofmonth(d) - 1)
    tod = F.unix_micros(ts) - F.unix_micros(F.to_timestamp(d))
    return F.timestamp_micros(F.unix_micros(F.to_timestamp(shifted)) + tod)


def _bounded(months: Column) -> Column:
    """Months back that a timestamp can hold (some 250,000 years); NULL beyond."""
    return F.when(months <= 3_000_000, months.cast("int"))


def _micros_back(ts: Column, n: Column, unit: int) -> Column:
    """``n`` units before ``ts``; NULL where that is no timestamp."""
    back = F.try_subtract(F.unix_micros(ts), F.try_multiply(n.cast("long"), F.lit(unit)))
    return F.when(back > -9_000_000_000_000_000_000, F.timestamp_micros(back))


def parse_relative_date(c, as_of) -> Column:
    """I3: 'N months/years/days/hours ago' relative to ``as_of``; keyword checks in the order
    month, year, day, hour ('Monday' hits the day branch); missing number means 1; falsy or
    unrecognised text gives ``as_of``."""
    s = _col(c)
    ts = _as_ts(as_of)
    digits = F.regexp_extract(s, r"(\d+)", 1)
    n = F.coalesce(F.when(digits != F.lit(""), digits).try_cast("int"), F.lit(1))
    return (F.when(~truthy(s), ts)
            .when(s.contains("month"), _months_back(ts, _bounded(n)))
            .when(s.contains("year"), _months_back(ts, _bounded(F.try_multiply(n.cast("long"), F.lit(12)))))
            .when(s.contains("day"), _micros_back(ts, n, 86_400_000_000))
            .when(s.contains("hour"), _micros_back(ts, n, 3_600_000_000))
            .otherwise(ts))


def seniority_label(title) -> Column:
    """I4: first matching keyword's label; MID when none; NULL for a falsy title."""
    from .rules import first_contained
    return F.when(truthy(_col(title)), first_contained(title, SENIORITY_RULES, default=DEFAULT_SENIORITY))


def seniority_map(title) -> Column:
    """I4 in warehouse form: ``{label: true}``, empty map for a falsy title."""
    label = seniority_label(title)
    return F.when(label.isNotNull(), F.create_map(label, F.lit(True))) \
        .otherwise(F.create_map().cast("map<string,boolean>"))


def parse_years_exp(c) -> Column:
    """First ``(\\d+)\\+?\\s*years?`` (case-sensitive); '1-3 years' → 3."""
    m = F.regexp_extract(_col(c), r"(\d+)\+?\s*years?", 1)
    return F.when(m != F.lit(""), m).try_cast("int")


def salary_numbers(c, strict: bool = True) -> Column:
    """Numbers of a salary text as strings; ``strict=False`` first drops thousands separators."""
    s = _col(c)
    if not strict:
        s = F.regexp_replace(s, r"(\d),(?=\d{3}\b)", "$1")
    return F.regexp_extract_all(s, F.lit(r"(\d+(\.\d+)?)"), 1)


def parse_salary(c, strict: bool = True) -> Column:
    """I6 → struct(min_value, max_value, currency, period), or NULL when the text is blank or
    has no number. Any K/k multiplies every number by 1000, else any M/m by 10^6."""
    s = _col(c)
    nums = salary_numbers(s, strict)
    mult = (F.when(s.contains("K") | s.contains("k"), F.lit(1000.0))
            .when(s.contains("M") | s.contains("m"), F.lit(1_000_000.0))
            .otherwise(F.lit(1.0)))
    first = F.try_element_at(nums, F.lit(1)).cast("double") * mult
    second = F.try_element_at(nums, F.lit(2)).cast("double") * mult
    sym = F.regexp_extract(s, f"([{CURRENCY_SYMBOLS}])", 1)
    currency = F.when(sym != F.lit(""), sym).otherwise(F.lit(DEFAULT_CURRENCY))
    present = truthy(F.trim(s)) & (F.size(nums) > 0)
    return F.when(present, F.struct(first.alias("min_value"),
                                     F.coalesce(second, first).alias("max_value"),
                                     currency.alias("currency"),
                                     F.lit(DEFAULT_PERIOD).alias("period")))


def flag_key(c) -> Column:
    return F.regexp_replace(F.lower(_col(c)), r"\s+", "")


def flag_map(c, default: str | None = None) -> Column:
    """I8: ``{lower(value without whitespace): true}``. With ``default`` a missing value uses it
    (job types → 'Unknown'); without, a missing value gives an empty map."""
    v = _col(c)
    if default is not None:
        v = F.when(truthy(v), v).otherwise(F.lit(default))
        return F.create_map(flag_key(v), F.lit(True))
    return F.when(truthy(v), F.create_map(flag_key(v), F.lit(True))) \
        .otherwise(F.create_map().cast("map<string,boolean>"))


def contains_ci(c, needle: str) -> Column:
    return F.coalesce(F.lower(_col(c)).contains(needle), F.lit(False))


def job_flags(location="location", title="title", job_type="type") -> dict[str, Column]:
    """Remote / manager / contractor flags, never NULL."""
    return {
        "remote": contains_ci(location, "remote"),
        "manager": contains_ci(title, "manager"),
        "contractor": contains_ci(job_type, "contract"),
    }


def remote_friendly(regions="regions") -> Column:
    return F.coalesce(F.array_contains(_col(regions), F.lit("Remote")), F.lit(False))


def epoch_seconds_to_ts(c) -> Column:
    """Epoch seconds → timestamp; falsy → NULL."""
    v = _col(c)
    return F.when(v.isNotNull() & (v != 0), F.timestamp_seconds(v))


def text_to_ts(c) -> Column:
    """ISO-8601 text or epoch-milliseconds text → timestamp; falsy or unparsable → NULL."""
    s = _col(c).cast("string")
    is_ms = s.rlike(r"^-?\d{10,}$")
    ms = F.timestamp_millis(F.when(is_ms, s).try_cast("long"))
    return F.when(~truthy(s), F.lit(None).cast("timestamp")).when(is_ms, ms).otherwise(F.try_to_timestamp(s))
