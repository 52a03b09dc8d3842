"""Wide, flat and nested exports of sites with their results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.functions import emails
from leadmill.functions.text import excel_safe

SOCIAL = ["linkedin", "facebook", "instagram", "twitter", "youtube", "github", "tiktok"]
WIDE = [
    "timestamp", "website", *[f"email {i}" for i in range(1, 11)], "phone", "address",
    "domain_created_at", "domain_expires_at", "domain_age_days", "homepage_markdown",
    *SOCIAL, "pages_crawled", "time_taken_sec", "status",
]


def joined(websites: DataFrame, results: DataFrame) -> DataFrame:
    """Sites with their result, or without."""
    w, r = websites.alias("w"), results.alias("r")
    site = ["id", "url", "domain", "status", "scraped_at", "time_taken_sec", "pages_crawled", "domain_created_at", "domain_expires_at", "domain_age_days", "homepage_markdown"]
    return w.join(r, F.col("w.id") == F.col("r.website_id"), "left").select(
        *[F.col(f"w.{c}") for c in site], *[F.col(f"r.{c}") for c in ("email", "phone", "address", *SOCIAL)], F.col("r.id").alias("result_id")
    )


def wide(websites: DataFrame, results: DataFrame) -> DataFrame:
    """The 28 columns of the wide export, with the site's id for its order."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    found = emails.from_labeled(F.coalesce("email", F.lit("")))
    mails = [F.coalesce(F.get(found, F.lit(i)), F.lit("")).alias(f"email {i + 1}") for i in range(10)]
    return joined(websites, results).select(
        "id",
        F.coalesce(F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias("timestamp"),
        text("url").alias("website"),
        *mails,
        *[text(c).alias(c) for c in ("phone", "address", "domain_created_at", "domain_expires_at", "domain_age_days", "homepage_markdown", *SOCIAL)],
        F.coalesce("pages_crawled", F.lit(0)).alias("pages_crawled"),
        F.coalesce("time_taken_sec", F.lit(0.0)).alias("time_taken_sec"),
        text("status").alias("status"),
    )


def workbook(websites: DataFrame, results: DataFrame) -> DataFrame:
    """The wide export with cells a workbook can hold."""
    df = wide(websites, results)
    return df.select(*[excel_safe(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def flat_emails(results: DataFrame) -> DataFrame:
    """Distinct addresses of all results."""
    return results.select(F.explode(emails.from_labeled(F.col("email"))).alias("email")).distinct()


def nested(websites: DataFrame, results: DataFrame) -> DataFrame:
    """(id, record): one JSON text for each site; a site with several results has the first result's
    fields and all addresses."""
    each = joined(websites, results)
    grouped = each.groupBy("id").agg(
        *[F.min_by(c, "result_id").alias(c) for c in ("phone", "address", *SOCIAL)],
        *[F.any_value(c).alias(c) for c in ("url", "domain", "status", "scraped_at", "time_taken_sec", "pages_crawled")],
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("result_id", "email"))), lambda x: emails.from_labeled(x["email"]))).alias("emails"),
    )
    record = F.struct(
        F.col("url").alias("website"), "domain", "status",
        F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "time_taken_sec", "pages_crawled", "emails", "phone", "address", F.struct(*SOCIAL).alias("social_links"),
    )
    return grouped.select("id", F.to_json(record, {"ignoreNullFields": "false"}).alias("record"))
