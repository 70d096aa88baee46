"""Column expressions on addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commgraph.functions.text import slugify

SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def _rest(url: Column) -> Column:
    return F.regexp_replace(url, SCHEME, "")


def netloc(url: Column) -> Column:
    """Authority with user and port, '' where the address has none."""
    return F.regexp_extract(_rest(url), "^//([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(_rest(url), "^//[^/?#]*", ""), "^([^?#]*)", 1)


def domain_key(url: Column) -> Column:
    return F.regexp_replace(netloc(url), r"^www\.", "")


def source_slug(url: Column) -> Column:
    """First label of the host, and the first path segment as a slug; 'unknown-source' without an address."""
    host = F.split(F.replace(netloc(url), F.lit("www."), F.lit("")), r"\.")[0]
    first = slugify(F.split(F.regexp_replace(path(url), "^/+|/+$", ""), "/")[0])
    return F.when(F.coalesce(url, F.lit("")) == "", "unknown-source").when(first == "", host).otherwise(F.concat_ws("-", host, first))


def article_id(title: Column, url: Column) -> Column:
    return F.concat_ws("_", slugify(title, 40), F.substring(F.md5(url), 1, 6))


def href_of(selector: Column) -> Column:
    """The address in a[href='...'], else null."""
    return F.nullif(F.regexp_extract(selector, r"^a\[href='(.*?)'\]", 1), F.lit(""))
