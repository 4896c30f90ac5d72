"""String enrichments (I1, I2, I7, I9, I11, I13, I20). Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import _col, truthy


def slugify(c, trim_dashes: bool = True, max_len: int | None = 100) -> Column:
    """Lower-case, runs of anything but [a-z0-9] become one '-', drop one dash at each end,
    cap the length. ``trim_dashes=False, max_len=None`` is the investor fallback form."""
    s = F.regexp_replace(F.lower(_col(c)), r"[^a-z0-9]+", "-")
    if trim_dashes:
        s = F.regexp_replace(s, r"^-|-$", "")
    if max_len is not None:
        s = F.substring(s, 1, max_len)
    return s


def slugify_or_empty(c) -> Column:
    """Slug of a falsy name is the empty string."""
    return F.when(truthy(c), slugify(c)).otherwise(F.lit(""))


def extract_domain(url) -> Column:
    """Host name of an absolute URL, lower-cased, without the port, with the first
    occurrence of 'www.' removed; text without scheme and host gives NULL. Hosts with underscores
    or letters beyond ASCII are kept as written."""
    host = F.lower(F.regexp_extract(_col(url), r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@\\]*@)?(\[[^\]]*\]|[^/?#:@\\\s]+)", 1))
    host = F.when(host != F.lit(""), host)
    return F.regexp_replace(host, r"^(.*?)www\.", "$1")


def split_locations(c) -> Column:
    """Comma list → trimmed elements (empty elements are kept here; importers drop them)."""
    return F.transform(F.split(_col(c), ","), lambda x: F.trim(x))


def absolutise(url, base: str, only_relative: bool = False) -> Column:
    """Prefix ``base``. ``only_relative`` = only when the value starts with '/' (otherwise
    the value is kept as is); the default form prefixes every truthy value."""
    u = _col(url)
    if only_relative:
        return F.when(u.startswith("/"), F.concat(F.lit(base), u)).otherwise(u)
    return F.when(truthy(u), F.concat(F.lit(base), u))


def strip_html(c) -> Column:
    """Remove ``<...>`` tags, lazily, never across a line break."""
    return F.regexp_replace(_col(c), r"<[^\n]*?>", "")


def id_from_url(c) -> Column:
    """The number in ``/jobs/<digits>/``, else the last path segment."""
    u = _col(c)
    by_jobs = F.regexp_extract(u, r"/jobs/(\d+)/", 1)
    return F.when(by_jobs != F.lit(""), by_jobs).otherwise(F.element_at(F.split(u, "/"), -1))


def founder_id(name, linkedin, twitter, bio) -> Column:
    """sha256 of lower(name::linkedin::twitter::first 50 chars of bio), missing → ''."""
    def s(c):
        c = _col(c)
        return F.when(truthy(c), c).otherwise(F.lit(""))
    ident = F.concat_ws("::", s(name), s(linkedin), s(twitter), F.substring(s(bio), 1, 50))
    return F.sha2(F.lower(ident), 256)


def surrogate_id(*cols) -> Column:
    """Reproducible surrogate key: sha256 of the natural key parts joined by '::'."""
    return F.sha2(F.concat_ws("::", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]), 256)
