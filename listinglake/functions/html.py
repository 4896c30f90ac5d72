"""Pattern-based extraction from stored HTML pages.

These are regular-expression extractions over the whole page text, not a DOM parser: they
find attributes and hrefs wherever they are in the document.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import _col

# Social sites recognised in hrefs, as (key, needle) in checking order. When an
# href matches several, every matching key is set; per key the last matching href wins.
SOCIAL_SITES = [
    ("linkedin", "linkedin.com"),
    ("twitter", "twitter.com"),
    ("facebook", "facebook.com"),
    ("github", "github.com"),
    ("instagram", "instagram.com"),
    ("youtube", "youtube.com"),
    ("medium", "medium.com"),
    ("crunchbase", "crunchbase.com"),
    ("angellist", "angel.co"),
]

#: a character reference: decimal, hexadecimal or named
ENTITY_RE = "&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
REPLACEMENT = "\uFFFD"

# the quoted value with its quotes; the space before the name keeps attributes like data-href out
QUOTED = r"""\s*=\s*("[^"]*"|'[^']*')"""
HREF_RE = r"(?i)<a\b[^>]*?\shref" + QUOTED
ANCHOR_RE = r"(?is)<a\b[^>]*?\shref" + QUOTED + r"[^>]*>(.*?)</a\s*>"


def _character(ref: Column, names: Column) -> Column:
    """What a character reference (without & and ;) stands for; an unknown name stays as it is written."""
    code = F.when(F.lower(F.substring(ref, 1, 2)) == "#x", F.conv(F.substring(ref, 3, 32), 16, 10)) \
        .when(ref.startswith("#"), F.substring(ref, 2, 32)).try_cast("bigint")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (F.when(ref.startswith("#"), F.when(valid, char).otherwise(F.lit(REPLACEMENT)))
             .otherwise(F.coalesce(F.try_element_at(names, ref), F.concat(F.lit("&"), ref, F.lit(";")))))


def decode_entities(c) -> Column:
    """Character references decoded in one pass from left to right: decimal, hexadecimal and the HTML 4 names (and
    ``&apos;``). What a reference stands for is never read again, so ``&amp;quot;`` is ``&quot;``. References to no
    character are U+FFFD."""
    s = _col(c)
    names = F.create_map(*[F.lit(x) for name, code in [*sorted(name2codepoint.items()), ("apos", 39)] for x in (name, chr(code))])
    refs = F.transform(F.regexp_extract_all(s, F.lit(ENTITY_RE), 1), lambda r: _character(r, names))
    parts = F.zip_with(F.split(s, ENTITY_RE, -1), refs, lambda text, char: F.concat(text, F.coalesce(char, F.lit(""))))
    return F.when(s.contains("&"), F.array_join(parts, "")).otherwise(s)


def _unquoted(value: Column) -> Column:
    return decode_entities(F.substring(value, 2, F.length(value) - 2))


def data_page_attr(html) -> Column:
    """Entity-decoded value of the first ``data-page`` attribute, NULL when absent or empty."""
    raw = F.regexp_extract(_col(html), r"\sdata-page" + QUOTED, 1)
    return F.get(F.transform(F.array(raw), lambda v: F.when(F.length(v) > 2, _unquoted(v))), 0)


def page_payload(attr, schema) -> Column:
    """``struct<data, error>`` of a ``data-page`` value: the typed payload, or why there is none."""
    a = _col(attr)
    return F.when(a.isNull(), F.struct(F.lit(None).cast(schema).alias("data"), F.lit("no data-page attribute").alias("error"))) \
        .when(F.json_object_keys(a).isNull(), F.struct(F.lit(None).cast(schema).alias("data"), F.lit("unparsable data-page").alias("error"))) \
        .otherwise(F.struct(F.from_json(a, schema).alias("data"), F.lit(None).cast("string").alias("error")))


def status_label(html) -> Column:
    """Text after a ``Status:`` label span, whitespace collapsed; 'Unknown' when absent."""
    raw = F.regexp_extract(_col(html), r"Status:\s*</span>\s*<span[^>]*>([^<]*)</span>", 1)
    clean = F.trim(F.regexp_replace(raw, r"\s+", " "))
    return F.when(clean != F.lit(""), clean).otherwise(F.lit("Unknown"))


def hrefs(html) -> Column:
    """All href values of anchors, in document order, entities decoded: one pass, the quotes cut off afterwards."""
    return F.transform(F.regexp_extract_all(_col(html), F.lit(HREF_RE), 1), _unquoted)


def social_links(html) -> Column:
    """Map site → last matching href, plus ``website`` = first http(s) href that is not a
    social link. Empty map when nothing is found."""
    def links(hs):
        def last(needle):
            return F.try_element_at(F.filter(hs, lambda h: h.contains(needle)), F.lit(-1))

        def not_social(h):
            cond = h.startswith("http")
            for _, needle in SOCIAL_SITES:
                cond = cond & ~h.contains(needle)
            return cond
        pairs = [F.struct(F.lit(key).alias("k"), last(needle).alias("v")) for key, needle in SOCIAL_SITES]
        pairs.append(F.struct(F.lit("website").alias("k"), F.try_element_at(F.filter(hs, not_social), F.lit(1)).alias("v")))
        return F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"].isNotNull()))
    # the hrefs are found once: all ten filters refer to one bound value
    return F.get(F.transform(F.array(hrefs(html)), links), 0)


def job_links(html, base: str, needle: str = "/jobs/") -> Column:
    """Anchors whose href contains ``needle`` and does not end with it, made absolute,
    with their anchor text (markup inside the anchor left out) → array<struct<href, text>>."""
    h = _col(html)
    links = F.transform(F.regexp_extract_all(h, F.lit(ANCHOR_RE), 1), _unquoted)
    texts = F.transform(F.regexp_extract_all(h, F.lit(ANCHOR_RE), 2),
                        lambda t: decode_entities(F.regexp_replace(t, r"<[^>]*>", "")))
    zipped = F.arrays_zip(links.alias("href"), texts.alias("text"))
    keep = F.filter(zipped, lambda z: z["href"].contains(needle) & ~z["href"].endswith(needle))
    return F.transform(keep, lambda z: F.struct(
        F.when(z["href"].startswith("http"), z["href"]).otherwise(F.concat(F.lit(base), z["href"])).alias("href"),
        F.trim(z["text"]).alias("text")))
