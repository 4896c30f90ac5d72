"""JSON / map / struct enrichments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .core import _col, truthy

# The link keys kept on a company record.
KEPT_LINK_KEYS = ["linkedin", "twitter", "facebook", "website"]


def json_array_to_strings(c) -> Column:
    """JSON array text → array<string>; NULL or unparsable → empty array. Object elements
    come back as their JSON text."""
    return F.coalesce(F.from_json(_col(c), T.ArrayType(T.StringType())), F.array().cast("array<string>"))


def _label_then_value(e: Column, first: str, second: str) -> Column:
    a = F.get_json_object(e, f"$.{first}")
    b = F.get_json_object(e, f"$.{second}")
    obj = F.when(truthy(a), a).when(truthy(b), b)
    return F.when(F.ltrim(e).startswith("{"), obj).otherwise(e)


def unwrap_label(e) -> Column:
    """I16 for one element (JSON text or plain string): a string stays, an object gives its
    label, else its value; falsy → NULL."""
    v = _label_then_value(_col(e), "label", "value")
    return F.when(truthy(v), v)


def unwrap_value(e) -> Column:
    """I16, salary currency / period form: value first, then label."""
    v = _label_then_value(_col(e), "value", "label")
    return F.when(truthy(v), v)


def unwrap_labels(arr) -> Column:
    """I16 over an array of element texts, falsy results dropped."""
    return F.filter(F.transform(_col(arr), lambda x: unwrap_label(x)), lambda x: x.isNotNull())


def merge_links(left, right) -> Column:
    """Right map overrides left on shared keys (plain map_concat raises on duplicates)."""
    l, r = _col(left), _col(right)
    l = F.coalesce(l, F.create_map().cast("map<string,string>"))
    r = F.coalesce(r, F.create_map().cast("map<string,string>"))
    kept = F.map_filter(l, lambda k, v: ~F.array_contains(F.map_keys(r), k))
    return F.map_concat(kept, r)


def pick_links(m, keys: list[str] | None = None) -> Column:
    """Keep only the given keys with truthy values; an empty result is NULL."""
    keys = keys or KEPT_LINK_KEYS
    out = F.map_filter(_col(m), lambda k, v: k.isin(*keys) & truthy(v))
    return F.when(F.size(out) > 0, out)


def build_logos(thumb) -> Column:
    """``{url}`` when the thumbnail is truthy."""
    t = _col(thumb)
    return F.when(truthy(t), F.struct(t.alias("url")))


def build_website(url, label) -> Column:
    """``{url, label}`` when the website is truthy."""
    u = _col(url)
    return F.when(truthy(u), F.struct(u.alias("url"), _col(label).alias("label")))


def email_domains(domain) -> Column:
    """``[domain]`` or empty."""
    d = _col(domain)
    return F.when(d.isNotNull(), F.array(d)).otherwise(F.array().cast("array<string>"))


def json_text(c, dtype: T.DataType | None = None) -> Column:
    """Falsy → NULL, strings unchanged, nested values serialised."""
    c = _col(c)
    if dtype is None or isinstance(dtype, T.StringType):
        return F.when(truthy(c), c)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(c.isNotNull(), F.to_json(c))
    return F.when(truthy(c, dtype), c.cast("string"))
