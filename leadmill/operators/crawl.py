"""Assembly of a site's facts from its pages and scripts.

Facts are unioned by site after distinct rows: a site with very many pages is reduced on the map
side before its sets are collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.functions import emails, html, phones, social, urls
from leadmill.functions.status import is_challenge, site_status
from leadmill.operators.exports import SOCIAL
from leadmill.session import spread


def _stack(df: DataFrame, site: str, sets: dict[str, Column]) -> DataFrame:
    """(site, kind, value) of several arrays in one pass; ``site`` is the name of that column."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("array<string>").alias("l")) for k, v in sets.items()])
    # the outer form: explode() would have its array computed once more for an inferred filter
    stacked = df.select(site, F.explode_outer(each).alias("s"))
    return stacked.select(site, "s.kind", F.explode_outer("s.l").alias("value"))


def home_addresses(sites: DataFrame) -> DataFrame:
    """(site, place, url): the address of each home page to try, and behind it the one with www. in front of a host without."""
    base = F.regexp_replace(F.when(F.col("url").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("url")).otherwise(F.concat(F.lit("https://"), "url")), "/+$", "")
    host = urls.netloc(base)
    tries = F.when(host.startswith("www."), F.array(base)).otherwise(F.array(base, F.concat(F.lit("https://www."), host)))
    return sites.select("site", F.posexplode(tries).alias("place", "url"))


def pages_to_fetch(homes: DataFrame) -> DataFrame:
    """(site, place, url): behind the home pages (site, url, html or null), their links that speak of contacts, then the known contact paths; each once.

    A page that could not be fetched, or is no text, has no links, but its site's known paths are tried all the same.
    """
    base = F.regexp_replace("url", "/+$", "")
    known = homes.select("site", base.alias("base"), "html")
    parsed = spread(known.where("html is not null")).withColumn("page", html.parse("html"))
    links = html.contact_links(parsed, "site", "page", "base").select("site", F.col("place").alias("place"), F.col("contact_url").alias("url"))
    paths = known.select("site", F.posexplode(urls.contact_urls(F.col("base"))).alias("k", "url")).select("site", (F.col("k") + 100).alias("place"), "url")
    every = links.unionByName(paths).join(known.select("site", F.col("base").alias("url")), ["site", "url"], "left_anti")
    return every.groupBy("site", "url").agg(F.min("place").alias("place")).select("site", "place", "url")


def scripts_to_fetch(pages: DataFrame) -> DataFrame:
    """(site, url): the first five external scripts of each page (site, url, html) that may hold data, resolved, once for each site."""
    parsed = spread(pages.where("html is not null").select("site", "url", "html")).withColumn("page", html.parse("html"))
    each = parsed.select("site", "url", F.explode(html.script_urls(F.col("page"))).alias("src"))
    return each.select("site", urls.url_join("url", "src").alias("url")).where("url is not null").distinct()


def assemble(pages: DataFrame, scripts: DataFrame, bad_domains: list[str] | None = None) -> DataFrame:
    """One row of facts for each site.

    ``pages``: site, url, content_type, html, is_home, error; ``scripts``: site, body. Pages that are
    no text, or that check visitors, give no facts; Markdown comes from the home page alone.
    """
    is_text = F.contains(F.lower(F.coalesce("content_type", F.lit("text/html"))), F.lit("text"))
    fit = pages.where(is_text & ~is_challenge(F.col("html"), F.col("url")))
    page, body, text = F.col("page"), F.col("body"), F.col("html")
    domain = F.regexp_replace(F.lower("site"), r"^www\.", "")
    of_page = {
        "emails": html.page_emails(text, page, bad_domains),
        "phones": F.transform(html.page_phone_candidates(page), lambda p: phones.clean_phone(p, F.col("hint"))),
        "addresses": html.page_addresses(page),
        **{p: html.page_social(text, page, p) for p in SOCIAL},
    }
    of_script = {
        "emails": emails.from_text(body, bad_domains),
        "phones": F.transform(phones.from_script(body), lambda p: phones.clean_phone(p, phones.country_hint(body, F.col("site")))),
        "addresses": html.script_addresses(body),
        **{p: social.from_text(body, p) for p in SOCIAL},
    }
    parsed = spread(fit.select("site", "html", domain.alias("domain"))).withColumn("page", html.parse("html"))
    hinted = parsed.withColumn("hint", phones.country_hint(F.col("page.text"), F.col("domain")))
    facts = _stack(hinted, "site", of_page).unionByName(_stack(scripts, "site", of_script)).where("value is not null").distinct()
    kinds = ["emails", "phones", "addresses", *SOCIAL]
    sets = facts.groupBy("site").agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("value")))).alias(k) for k in kinds])
    counts = pages.groupBy("site").agg(F.count("*").alias("pages_crawled"), F.min("error").alias("error_message"))
    # the text is made before the exchange, so raw pages are not shuffled
    home = spread(fit.where("is_home").select("site", "url", "html")).select("site", "url", html.markdown("html").alias("markdown"))
    home = home.groupBy("site").agg(F.min_by("markdown", "url").alias("homepage_markdown"))
    out = counts.join(sets, "site", "left").join(home, "site", "left")
    any_data = F.lit(False)
    for k in kinds:
        any_data = any_data | (F.coalesce(F.size(k), F.lit(0)) > 0)
    joined = lambda c, by: F.coalesce(F.array_join(c, by), F.lit(""))
    return out.select(
        "site",
        emails.labeled(F.col("emails")).alias("email"),
        joined("phones", ", ").alias("phone"),
        joined(html.top_addresses(F.col("addresses")), " | ").alias("address"),
        *[joined(p, ", ").alias(p) for p in SOCIAL],
        F.coalesce("homepage_markdown", F.lit("")).alias("homepage_markdown"),
        "pages_crawled", "error_message", site_status(any_data, F.col("error_message")).alias("status"),
    )
