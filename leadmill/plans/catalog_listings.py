"""More core queries: listings, keyword states, best e-mail of a site, counters, unions of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadmill.functions import emails, status, text, urls
from leadmill.operators import dedupe, state
from leadmill.plans import sql_parts as S
from leadmill.schemas import LISTING_COLUMNS
from leadmill.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _given(c: str) -> str:
    return f"""coalesce(nullif({S.strip(f'"{c}"')}, ''), 'Not available')"""


_TEXTS = [c for c in LISTING_COLUMNS if c != "Time Taken (sec)"]


@query("SELECT lead_id, " + ", ".join(f'{_given(c)} AS "{c}"' for c in _TEXTS) + ', round("Time Taken (sec)", 2) AS "Time Taken (sec)" FROM final_output')
def listing_rows(spark, sf_dir):
    """Stored listings in the fixed columns with the sentinel for what is missing."""
    df = table(spark, sf_dir, "final_output")
    filled = df.select("lead_id", *[text.or_not_available(F.col(f"`{c}`")).alias(c) for c in _TEXTS], F.round("`Time Taken (sec)`", 2).alias("Time Taken (sec)"))
    return state.order_columns(filled, ["lead_id", *LISTING_COLUMNS])


@query("""
    WITH s AS (SELECT keyword, count(DISTINCT href) AS n, max(CASE WHEN href = '__SINGLE__' THEN 1 ELSE 0 END) AS single FROM progress WHERE keyword IS NOT NULL GROUP BY keyword),
    k AS (SELECT DISTINCT "Search Term" AS keyword FROM final_output WHERE "Search Term" IS NOT NULL)
    SELECT keyword FROM k WHERE keyword NOT IN (SELECT keyword FROM s WHERE n >= 3 OR single = 1)""")
def keywords_pending(spark, sf_dir):
    """Keywords whose state is not completed (here: three results in the log, or the single-result mark)."""
    logged = table(spark, sf_dir, "progress").where("keyword is not null").groupBy("keyword").agg(
        F.countDistinct("href").alias("n"), F.max(F.when(F.col("href") == "__SINGLE__", 1).otherwise(0)).alias("single")
    )
    done = logged.where("n >= 3 or single = 1").select("keyword")
    every = table(spark, sf_dir, "final_output").where("`Search Term` is not null").select(F.col("Search Term").alias("keyword"))
    return state.missing_keys(every, done, "keyword")


_MAILTO = f"list_filter(regexp_extract_all(coalesce(email, ''), 'mailto:([^\"''?&\\s]+)', 1), lambda m: regexp_full_match(m, '{emails.LISTING}'))"


@query(f"""SELECT id, coalesce(list_min({_MAILTO}), list_min({S.listing_emails("coalesce(email, '')")}), list_min({S.listing_emails("coalesce(homepage_markdown, '')")}), 'Not available') AS email
    FROM extracted_results""")
def site_email_best(spark, sf_dir):
    """The smallest mailto address, else the smallest candidate of the field, else of the page."""
    e, page = F.coalesce("email", F.lit("")), F.coalesce("homepage_markdown", F.lit(""))
    found = F.regexp_extract_all(e, F.lit(r"""mailto:([^"'?&\s]+)"""), F.lit(1))
    mailto = F.filter(found, lambda m: m.rlike(f"^{emails.LISTING}$"))
    best = F.coalesce(F.array_min(mailto), F.array_min(emails.listing_candidates(e)), F.array_min(emails.listing_candidates(page)), F.lit(text.NOT_AVAILABLE))
    return table(spark, sf_dir, "extracted_results").select("id", best.alias("email"))


_KEPT = f"""(SELECT {S.strip('"Website"')} AS website, "Available" AS available FROM status_checked)"""


@query(f"""
    WITH u AS (SELECT website, available, {S.bare_domain('website')} AS domain, {S.root_url('website')} AS root FROM {_KEPT})
    SELECT count(*) AS n_rows, count(*) FILTER (lower({S.strip('available')}) = 'yes' AND website <> '') AS n_available,
      count(*) FILTER (lower({S.strip('available')}) = 'yes' AND website <> '' AND domain <> '' AND root <> '' AND NOT {S.is_platform('domain')}) AS n_fit,
      count(DISTINCT CASE WHEN lower({S.strip('available')}) = 'yes' AND website <> '' AND domain <> '' AND root <> '' AND NOT {S.is_platform('domain')} THEN domain END) AS n_domains FROM u""")
def clean_url_counts(spark, sf_dir):
    """Counters of the URL clean-up."""
    w = text.py_strip(F.col("Website"))
    u = table(spark, sf_dir, "status_checked").select(w.alias("w"), F.col("Available").alias("a"), urls.bare_domain(w).alias("domain"), urls.root_url(w).alias("root"))
    available = status.is_available(F.col("a")) & (F.col("w") != "")
    fit = available & (F.col("domain") != "") & (F.col("root") != "") & ~urls.is_platform(F.col("domain"))
    return u.agg(F.count("*").alias("n_rows"), F.count_if(available).alias("n_available"), F.count_if(fit).alias("n_fit"), F.countDistinct(F.when(fit, F.col("domain"))).alias("n_domains"))


_FILES = """(SELECT 0 AS file_ord, lead_id AS ord, "Website" AS website FROM status_checked UNION ALL SELECT 1, lead_id, "Website" FROM final_output)"""


@query(f"""
    WITH u AS (SELECT file_ord, ord, website AS original_url, {S.bare_domain('website')} AS domain, {S.root_url('website')} AS website FROM {_FILES}),
    r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY file_ord, ord) AS k FROM u WHERE domain <> '' AND website <> '' AND NOT {S.is_platform('domain')})
    SELECT website, domain, file_ord, min(original_url) AS original_url FROM r WHERE k = 1 GROUP BY ALL""")
def clean_urls_across_files(spark, sf_dir):
    """One root URL for each domain over two inputs in their order."""
    a = table(spark, sf_dir, "status_checked").select(F.lit(0).alias("file_ord"), F.col("lead_id").alias("ord"), F.col("Website").alias("website"))
    b = table(spark, sf_dir, "final_output").select(F.lit(1).alias("file_ord"), F.col("lead_id").alias("ord"), F.col("Website").alias("website"))
    u = F.col("website")
    every = a.unionByName(b).select("file_ord", "ord", u.alias("original_url"), urls.bare_domain(u).alias("domain"), urls.root_url(u).alias("website"))
    fit = every.where((F.col("domain") != "") & (F.col("website") != "") & ~urls.is_platform(F.col("domain")))
    return dedupe.keep_first(fit, F.col("domain"), "file_ord", "ord", "original_url").select("website", "domain", "file_ord", "original_url")


@query("""SELECT r.id, w.domain, r.email, r.phone FROM extracted_results r JOIN websites w ON w.id = r.website_id""")
def recheck_join(spark, sf_dir):
    """Results with the domain of their site."""
    w = table(spark, sf_dir, "websites").select(F.col("id").alias("website_id"), "domain")
    return table(spark, sf_dir, "extracted_results").join(w, "website_id").select("id", "domain", "email", "phone")


@query("SELECT website_id, id AS newest, n FROM (SELECT *, row_number() OVER (PARTITION BY website_id ORDER BY created_at DESC NULLS LAST, id DESC) AS k, count(*) OVER (PARTITION BY website_id) AS n FROM extracted_results) WHERE k = 1")
def newest_results(spark, sf_dir):
    """The newest result of each site and how many it has."""
    r = table(spark, sf_dir, "extracted_results")
    counts = r.groupBy("website_id").agg(F.count("*").alias("n"), F.max_by("id", F.struct(F.col("created_at").isNotNull(), "created_at", "id")).alias("newest"))
    return counts.select("website_id", "newest", "n")
