"""Keep-first de-duplication by keys.

All passes are ``row_number() == 1`` windows: Spark puts a group limit before the exchange, so each
task sends one row of a key at most, and a key that holds a third of all rows is no hot spot.
Rows without a key get one of their own and never merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadmill.functions import urls
from leadmill.functions.text import digits_only, has_value
from leadmill.session import materialize


def keep_first(df: DataFrame, key: Column, *order: Column | str) -> DataFrame:
    """The first row of each key in the given order."""
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")


def own_key(key: Column, missing: Column, ord_col: Column) -> Column:
    """The key, or one of the row's own where it is missing."""
    return F.when(missing, F.concat(F.coalesce(key, F.lit("")), F.lit("||row"), ord_col.cast("string"))).otherwise(key)


def phone_key(phone: Column, ord_col: Column) -> Column:
    return own_key(digits_only(phone), ~has_value(phone), ord_col)


def site_key(website: Column, ord_col: Column) -> Column:
    return own_key(urls.website_key(website), ~has_value(website), ord_col)


def with_contact(df: DataFrame, website: str, phone: str) -> DataFrame:
    """Rows with a website or a phone."""
    return df.where(has_value(F.col(website)) | has_value(F.col(phone)))


def dedupe_by_phone(df: DataFrame, phone: str, ord_col: str) -> DataFrame:
    return keep_first(df, phone_key(F.col(phone), F.col(ord_col)), ord_col)


def dedupe_by_site(df: DataFrame, website: str, ord_col: str) -> DataFrame:
    return keep_first(df, site_key(F.col(website), F.col(ord_col)), ord_col)


def dedupe_by_both(df: DataFrame, website: str, phone: str, ord_col: str) -> DataFrame:
    """The third pass, literally. After the other two it removes nothing: rows with a website have
    distinct website keys by then, and rows without a field have keys of their own."""
    missing = ~has_value(F.col(website)) | ~has_value(F.col(phone))
    both = F.concat(urls.website_key(F.col(website)), F.lit("||"), digits_only(F.col(phone)))
    return keep_first(df, own_key(both, missing, F.col(ord_col)), ord_col)


def cascade(df: DataFrame, website: str, phone: str, ord_col: str) -> DataFrame:
    """Rows with a contact, first by phone, then by website; two shuffles."""
    return dedupe_by_site(dedupe_by_phone(with_contact(df, website, phone), phone, ord_col), website, ord_col)


#: The stages of the cascade; its third pass removes nothing.
STAGES = ["input", "has_contact", "phone", "website", "phone_and_website"]


def stage_counts(df: DataFrame, website: str, phone: str, ord_col: str) -> DataFrame:
    """(stage, n_rows, n_removed) of the cascade."""
    slim = df.select(website, phone, ord_col)
    # one scan counts the input and the rows with a contact; what is left by phone is written down once and counted twice
    contact = has_value(F.col(website)) | has_value(F.col(phone))
    by_phone = materialize(dedupe_by_phone(with_contact(slim, website, phone), phone, ord_col), "by-phone")
    named = lambda **counts: F.inline(F.array(*[F.struct(F.lit(k).alias("stage"), c.alias("n_rows")) for k, c in counts.items()]))
    n = F.count("*")
    out = (
        slim.agg(n.alias("a"), F.count_if(contact).alias("b")).select(named(input=F.col("a"), has_contact=F.col("b")))
        .unionByName(by_phone.agg(n.alias("a")).select(named(phone=F.col("a"))))
        .unionByName(dedupe_by_site(by_phone, website, ord_col).agg(n.alias("a")).select(named(website=F.col("a"), phone_and_website=F.col("a"))))
    )
    before = F.lag("n_rows").over(Window.orderBy(F.array_position(F.lit(STAGES), F.col("stage"))))
    return out.withColumn("n_removed", F.coalesce(before - F.col("n_rows"), F.lit(0)).cast("bigint")).select("stage", "n_rows", "n_removed")


def clean_urls(df: DataFrame, url: str, *order: str) -> DataFrame:
    """One root URL for each domain that is no platform: (website, domain, original_url), first in order.

    The tests on host and root come before the window: a row they drop must not take a domain.
    """
    u = F.col(url)
    with_parts = df.select(urls.root_url(u).alias("website"), urls.bare_domain(u).alias("domain"), u.alias("original_url"), *order)
    fit = with_parts.where((F.col("domain") != "") & ~urls.is_platform(F.col("domain")) & (F.col("website") != ""))
    return keep_first(fit, F.col("domain"), *order).select("website", "domain", "original_url")
