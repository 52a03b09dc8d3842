"""What a run does before its pages are fetched, by its options: interrupted work back in the queue, retries, new sites, or rechecks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.functions import phones
from leadmill.operators import exports, state
from leadmill.session import materialize

#: States that a retry puts back in the queue.
RETRIED = ["failed", "no_data"]


@dataclass(frozen=True)
class Options:
    """``assume_country`` is that of phone numbers without any sign of theirs."""

    retry: bool = True
    recheck_existing: bool = False
    export_only: bool = False
    assume_country: str = "ca"


@dataclass(frozen=True)
class Start:
    """The tables after the preparation, and the sites to fetch; none if the run only exports."""

    websites: DataFrame
    results: DataFrame
    pending: DataFrame


def begin(websites: DataFrame, results: DataFrame, incoming: DataFrame, options: Options = Options(), url: str = "url", ord_col: str = "ord") -> Start:
    """Interrupted sites are pending again; then retries, also before an export alone; then either rechecks, nothing, or the new sites of the list."""
    sites = state.reset_interrupted(websites)
    if options.retry:
        results = state.requeue_results(results, sites, RETRIED)
        sites = state.requeue(sites, RETRIED)
    if options.recheck_existing:
        results = rechecked(results, sites, options.assume_country)
    if options.recheck_existing or options.export_only:
        return Start(sites, results, sites.limit(0))
    sites = materialize(sites, "queue")
    fresh, rows = state.load_queue(incoming, url, ord_col, sites)
    following = results.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    numbered = rows.withColumn("id", following + F.col("website_id") - sites.agg(F.coalesce(F.max("id"), F.lit(0))).scalar())
    sites = sites.unionByName(fresh, allowMissingColumns=True)
    return Start(sites, results.unionByName(numbered, allowMissingColumns=True), sites.where("status = 'pending'"))


def rechecked(results: DataFrame, websites: DataFrame, assume_country: str = "ca") -> DataFrame:
    """Stored phones with their country codes derived anew from address, page and domain; nothing is fetched."""
    about = F.concat_ws(" ", F.nullif("address", F.lit("")), F.nullif("homepage_markdown", F.lit("")))
    hinted = results.where("phone <> ''").join(websites.select(F.col("id").alias("website_id"), "domain"), "website_id")
    hinted = hinted.select("id", "phone", phones.country_hint(about, F.col("domain")).alias("hint"))
    fixed = phones.recheck_table(hinted, "id", "phone", "hint", assume_country).select("id", "fixed")
    return results.join(fixed, "id", "left").withColumn("phone", F.coalesce("fixed", "phone")).drop("fixed")


def exported(start: Start) -> dict[str, DataFrame]:
    """The three exports: one row for each site, the workbook's cells, and all addresses, in their order."""
    return {
        "wide": exports.wide(start.websites, start.results).orderBy("id"),
        "workbook": exports.workbook(start.websites, start.results).orderBy("id"),
        "flat": exports.flat_emails(start.results).orderBy("email"),
    }
