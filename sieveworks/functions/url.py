"""URL scalars as native columns, by one split into scheme, authority, path, query and fragment."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .text import present, strip, text

# Fixed values.
SHORTENERS = ("wa.me", "t.co", "bit.ly", "ow.ly", "tinyurl.com")
PREFIX_LABELS = ("careers", "jobs", "apply", "recruiting", "talent", "www")
COUNTRY_SUFFIXES = (".com.au", ".co.uk", ".com.br", ".co.in", ".co.nz")
ACRONYMS = {"ea": "EA", "ge": "GE", "hp": "HP", "3m": "3M"}
#: Suffix of the vendor whose customers have subdomains; a parameter everywhere.
VENDOR = ".hirewell.example"

_SPLIT = r"^(?s)(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(c: Column, n: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query, 5 fragment; '' where absent."""
    return F.regexp_extract(text(c), _SPLIT, n)


def normalised(c: Column) -> Column:
    """Stripped, final slashes off, https added where no http(s) prefix stands, host in lower case, query and fragment dropped."""
    u = F.regexp_replace(strip(text(c)), "/+$", "")
    u = F.when(F.startswith(u, F.lit("http://")) | F.startswith(u, F.lit("https://")), u).otherwise(F.concat(F.lit("https://"), u))
    return F.when(present(c), F.concat(F.lower(part(u, 1)), F.lit("://"), F.lower(part(u, 2)), part(u, 3))).otherwise(F.lit(""))


def domain(c: Column) -> Column:
    """Authority in lower case, with port and user; '' without a scheme."""
    return F.lower(part(c, 2))


def company(c: Column, vendor: str = VENDOR) -> Column:
    """Company name by the host."""
    d = domain(c)
    labels = F.split(d, r"\.")
    n = F.size(labels)
    at = lambda i: F.coalesce(F.try_element_at(labels, F.lit(i)), F.lit(""))
    sub = F.split(F.replace(d, F.lit(vendor), F.lit("")), r"\.")
    last, before = F.coalesce(F.try_element_at(sub, F.lit(-1)), F.lit("")), F.coalesce(F.try_element_at(sub, F.lit(-2)), F.lit(""))
    hosted = F.when(F.size(sub) > 1, F.when(last != "jobs", last).otherwise(before)).otherwise(last)
    country = F.lit(False)
    for s in COUNTRY_SUFFIXES:
        country = country | F.endswith(d, F.lit(s))
    prefixed = at(1).isin(*PREFIX_LABELS)
    own = (
        F.when(n < 2, at(1))
        .when(prefixed, F.when(country & (n >= 4), at(-3)).otherwise(at(-2)))
        .when(country & (n >= 3), at(-3))
        .otherwise(F.when(n > 2, at(-2)).otherwise(at(1)))
    )
    label = F.when(F.contains(d, F.lit(vendor)), hosted).otherwise(own)
    words = F.filter(F.split(F.translate(label, "-_", "  "), " +"), lambda w: w != "")
    named = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))), " ")
    for low, up in ACRONYMS.items():
        named = F.when(F.lower(label) == low, F.lit(up)).otherwise(named)
    return F.when(d.isin(*SHORTENERS), F.lit("Unknown")).otherwise(named)


def job_id(c: Column) -> Column:
    """A last segment of four digits or more; else the first such segment start; else the query's jobId, then id; else NULL."""
    tail = F.regexp_extract(F.regexp_replace(text(c), "/+$", ""), r"(?:^|/)(\d{4,})$", 1)
    inner = F.regexp_extract(text(c), r"/(\d{4,})(?:[/?#]|$)", 1)
    query = [F.regexp_extract(text(c), rf"(?i)[?&]{k}=(\d+)", 1) for k in ("jobId", "id")]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (tail, inner, *query)])


def is_vendor(c: Column, vendor: str = VENDOR) -> Column:
    return F.contains(domain(c), F.lit(vendor.lstrip(".")))


@F.pandas_udf(T.StringType())
def absolute(base: pd.Series, href: pd.Series) -> pd.Series:
    """RFC 3986 resolution; no native function resolves dot segments."""

    def one(b, h):
        try:
            return urljoin(b or "", h or "")
        except ValueError:
            return h

    return pd.Series([one(b, h) for b, h in zip(base, href)])


def repaired_mailto(c: Column) -> Column:
    """The address within a mailto link's body, else the value itself."""
    found = F.regexp_extract(F.coalesce(F.try_url_decode(c), c), r"(?i)^mailto:.*?(https?://[^\s&\"'<>]+)", 1)
    return F.when(F.lower(c).startswith("mailto:") & (found != ""), found).otherwise(c)


def locale_prefix(c: Column) -> Column:
    """The xx_YY segment of the path, NULL if none."""
    return F.nullif(F.regexp_extract(part(c, 3), r"/([a-z]{2}_[A-Z]{2})(?:/|$)", 1), F.lit(""))


def remedied(c: Column) -> Column:
    """A bare domain as https address of its careers page."""
    u = strip(text(c))
    return F.when(u.rlike("^http"), u).when(u != "", F.concat(F.lit("https://"), u, F.lit("/careers"))).otherwise(F.lit(""))
