"""URL parts and keys as column expressions. Host names that URL parsers refuse are kept."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.functions.text import py_strip, strip_chars

NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
#: Platforms whose pages are no business's own site (fixed values).
PLATFORMS = [
    "facebook.com", "instagram.com", "twitter.com", "x.com", "youtube.com",
    "linkedin.com", "tiktok.com", "pinterest.com", "yelp.com",
    "sites.google.com", "g.page", "goo.gl", "maps.google.com",
    "business.google.com", "wa.me", "api.whatsapp.com", "t.me",
    "wikipedia.org", "amazon.com", "ebay.com",
]
#: Pages where a site may give its contacts (fixed values).
CONTACT_PATHS = ["/contact", "/contact-us", "/contactus", "/about", "/about-us", "/aboutus", "/team", "/our-team", "/leadership"]


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, NETLOC, 1)


def bare_domain(url: Column) -> Column:
    """Lower-case network location without one leading www.; ports stay."""
    return F.regexp_replace(F.lower(netloc(url)), r"^www\.", "")


def root_url(url: Column) -> Column:
    """scheme://host, or empty without a scheme or host."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    host = netloc(url)
    return F.when((scheme != "") & (host != ""), F.concat(scheme, F.lit("://"), host)).otherwise(F.lit(""))


def platform_pattern() -> str:
    return r"(^|\.)(" + "|".join(p.replace(".", r"\.") for p in PLATFORMS) + ")$"


def is_platform(domain: Column) -> Column:
    return domain.rlike(platform_pattern())


def website_key(c: Column) -> Column:
    """Lower case, without scheme, www. and closing slashes; path and query stay."""
    bare = F.regexp_replace(F.lower(py_strip(c)), r"^https?://", "")
    return F.regexp_replace(F.regexp_replace(bare, r"^www\.", ""), r"/+$", "")


def probe_url(c: Column) -> Column:
    """The URL to ask for: https:// in front where there is no scheme; empty for missing values."""
    s = py_strip(c)
    bare = strip_chars(s, "\"'")
    return (
        F.when(c.isNull() | (s == "") | F.lower(s).isin("nan", "none", "null"), F.lit(""))
        .when(F.lower(bare).rlike("^https?://"), bare)
        .otherwise(F.concat(F.lit("https://"), bare))
    )


def looks_like_url(c: Column) -> Column:
    """The test of column detection: with https:// where needed, the host has a dot."""
    s = py_strip(c)
    tested = F.when(F.lower(s).rlike(r"^(http://|https://|www\.)"), s).otherwise(F.concat(F.lit("https://"), s))
    return (s != "") & F.contains(netloc(tested), F.lit("."))


def queue_url(c: Column) -> Column:
    s = py_strip(c)
    return F.when(s.startswith("http"), s).otherwise(F.concat(F.lit("https://"), s))


def registrable(c: Column) -> Column:
    """A domain as asked of a registry: no scheme, path, port or www."""
    s = F.replace(F.replace(F.lower(c), F.lit("http://"), F.lit("")), F.lit("https://"), F.lit(""))
    s = F.substring_index(F.substring_index(s, "/", 1), ":", 1)
    return F.regexp_replace(s, r"^www\.", "")


def clean_social_url(c: Column) -> Column:
    return F.substring_index(F.regexp_replace(c, "/+$", ""), "?", 1)


def contact_urls(base: Column) -> Column:
    """The fixed pages to try for a site."""
    return F.array(*[F.concat(F.regexp_replace(base, "/+$", ""), F.lit(p)) for p in CONTACT_PATHS])


@F.pandas_udf(T.StringType())
def url_join(base: pd.Series, link: pd.Series) -> pd.Series:
    """Resolve links against their page; there is no built-in for it."""
    from urllib.parse import urljoin

    def one(b, h):
        try:
            return urljoin(b or "", h) if h is not None else None
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, link)], dtype=object)
