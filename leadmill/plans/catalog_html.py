"""HTML operators on pages made from the tables, with decoys beside what is to be found."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.functions import html
from leadmill.operators import crawl, exports
from leadmill.session import spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def made_pages(spark, sf_dir):
    """Pages that vary with the site's id: phone, mail, address, links, scripts, and decoys of each kind."""
    k = F.col("id").cast("string")
    part = lambda n, m: F.lpad((F.col("id") * n % m).cast("string"), len(str(m)) - 1, "3")
    text = F.concat(
        F.lit("<html><head><style>p{x:y}</style></head><body><h1>Site "), k, F.lit("</h1><p>Order "), k, F.lit(" of <b>2019</b>.</p>"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("<a href='tel:+1780555"), part(7, 10_000), F.lit("'>call</a>"))).otherwise(""),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("<a href='//www.facebook.com/shop"), k, F.lit("?x=1'>f</a>"))).otherwise("<a href='https://www.facebook.com/sharer.php'>s</a>"),
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("<a href='https://www.instagram.com/pic"), k, F.lit("/'>i</a>"))).otherwise(""),
        F.lit("<ul><li>one</li><li>two <i>"), k, F.lit("</i></li></ul><script src='/js/chunk-"), k, F.lit(".js'></script><script src='/pixel.gif'></script>"),
        F.lit("<a href='/kontakt-"), k, F.lit("'>Write</a> <a href='contact/"), k, F.lit("'>Contact</a> <a href='https://other.example/contact'>Contact</a></body></html>"),
    )
    return table(spark, sf_dir, "websites").select("id", F.concat(F.lit("https://h"), k, F.lit(".example/a/b")).alias("site"), F.concat(F.lit("h"), k, F.lit(".example")).alias("domain"), text.alias("html"))


def parsed(spark, sf_dir):
    return spread(made_pages(spark, sf_dir)).withColumn("page", html.parse("html"))


@query("SELECT id, '+1 (780) 555-' || lpad(CAST(id * 7 % 10000 AS VARCHAR), 4, '3') AS phone FROM websites WHERE id % 3 = 0")
def html_phone_links(spark, sf_dir):
    return html.page_phones(parsed(spark, sf_dir), "id", "page", "domain")


@query("SELECT id, 'https://www.facebook.com/shop' || id AS facebook FROM websites WHERE id % 2 = 0")
def html_social_varied(spark, sf_dir):
    return parsed(spark, sf_dir).select("id", F.explode(html.page_social(F.col("html"), F.col("page"), "facebook")).alias("facebook"))


@query("SELECT id, '/js/chunk-' || id || '.js' AS script FROM websites")
def html_scripts_varied(spark, sf_dir):
    return parsed(spark, sf_dir).select("id", F.explode(html.script_urls(F.col("page"))).alias("script"))


@query("SELECT id, CAST(1 AS INT) AS place, 'https://h' || id || '.example/a/contact/' || id AS contact_url FROM websites")
def contact_links_varied(spark, sf_dir):
    return html.contact_links(parsed(spark, sf_dir), "id", "page", "site")


@query("""SELECT w.id, to_json({'website': any_value(w.url), 'domain': any_value(w.domain), 'status': any_value(w.status), 'pages': any_value(w.pages_crawled), 'phone': arg_min(coalesce(r.phone, ''), r.id)}) AS record
    FROM websites w JOIN extracted_results r ON w.id = r.website_id GROUP BY w.id""")
def export_json_fields(spark, sf_dir):
    """Plain fields of the nested export, for the sites with results."""
    results = table(spark, sf_dir, "extracted_results").withColumn("phone", F.coalesce("phone", F.lit("")))
    sites = table(spark, sf_dir, "websites").join(results.select(F.col("website_id").alias("id")), "id", "left_semi")
    fields = "website string, domain string, status string, pages_crawled int, phone string"
    found = exports.nested(sites, results).select("id", F.from_json("record", fields).alias("r"))
    return found.select("id", F.to_json(F.struct("r.website", "r.domain", "r.status", F.col("r.pages_crawled").alias("pages"), "r.phone"), {"ignoreNullFields": "false"}).alias("record"))


@query("SELECT id, '# Site ' || id || chr(10) || chr(10) || 'Text **' || id || '** and *more*.' || chr(10) || chr(10) || '* one' || chr(10) || '* [two](/t' || id || ')' || chr(10) || chr(10) || '> said' AS markdown FROM websites")
def html_markdown_varied(spark, sf_dir):
    """Scripts, styles and comments fall away; headings, lists, links and quotes stay."""
    k = F.col("id").cast("string")
    page = F.concat(
        F.lit("<html><head><title>x</title><style>a{b:c}</style></head><body><!-- no --><h1>Site "), k, F.lit("</h1><script>var a=1;</script><p>Text <b>"), k,
        F.lit("</b> and <em>more</em>.</p><ul><li>one</li><li><a href='/t"), k, F.lit("'>two</a></li></ul><blockquote>said</blockquote></body></html>"),
    )
    return spread(table(spark, sf_dir, "websites").select("id", page.alias("html"))).select("id", html.markdown("html").alias("markdown"))


@query("""SELECT 'h' || id || '.example' AS site, 'email 1: info' || id || '@corp' || (id % 9) || '.biz' AS email,
      '+1 (780) 555-' || lpad(CAST(id * 7 % 10000 AS VARCHAR), 4, '3') AS phone, 'https://www.facebook.com/shop' || id AS facebook,
      '# Home ' || id AS homepage_markdown, CAST(3 AS BIGINT) AS pages_crawled, 'completed' AS status FROM websites WHERE id % 2 = 0
    UNION ALL SELECT 'h' || id || '.example', '', '', '', '', CAST(3 AS BIGINT), 'failed' FROM websites WHERE id % 2 = 1""")
def crawl_assembly_varied(spark, sf_dir):
    """Facts of a home page, a contact page and a file that is no text; every other site shows a browser check instead."""
    k = F.col("id").cast("string")
    phone = F.lpad((F.col("id") * 7 % 10_000).cast("string"), 4, "3")
    home = F.concat(F.lit("<html><body><h1>Home "), k, F.lit("</h1><a href='mailto:info"), k, F.lit("@corp"), (F.col("id") % 9).cast("string"), F.lit(".biz'></a></body></html>"))
    contact = F.concat(F.lit("<html><body><a href='tel:+1780555"), phone, F.lit("'>call</a><a href='https://www.facebook.com/shop"), k, F.lit("'>f</a></body></html>"))
    hidden = F.col("id") % 2 == 1
    page = lambda url, kind, text, is_home: F.struct(url.alias("url"), F.lit(kind).alias("content_type"), F.when(hidden, "Just a moment").otherwise(text).alias("html"), F.lit(is_home).alias("is_home"))
    base = F.concat(F.lit("https://h"), k, F.lit(".example"))
    each = F.array(page(base, "text/html", home, True), page(F.concat(base, F.lit("/contact")), "text/html; charset=utf-8", contact, False), page(F.concat(base, F.lit("/a.pdf")), "application/pdf", F.replace(home, F.lit("info"), F.lit("wrong")), False))
    error = F.when(hidden, "Connection failed or non-HTML response").alias("error")
    pages = table(spark, sf_dir, "websites").select(F.concat(F.lit("h"), k, F.lit(".example")).alias("site"), error, F.inline(each))
    scripts = spark.createDataFrame([], "site string, body string")
    return crawl.assemble(pages, scripts).select("site", "email", "phone", "facebook", "homepage_markdown", "pages_crawled", "status")


@query("SELECT id, (id % 300 + 1) || ' Harrow Street, Oldtown, BC V5K 0A' || (id % 10) AS address FROM websites")
def html_addresses_varied(spark, sf_dir):
    """The address of the footer, with a price list and a phone number that look a little like one."""
    k = F.col("id")
    place = F.concat((k % 300 + 1).cast("string"), F.lit(" Harrow Street, Oldtown, BC V5K 0A"), (k % 10).cast("string"))
    page = F.concat(F.lit("<html><body><p>Room 12, from $300 a night</p><p>Call 780 555 0142</p><footer class='footer'><p>"), place, F.lit("</p></footer></body></html>"))
    parsed_ = spread(table(spark, sf_dir, "websites").select("id", page.alias("html"))).withColumn("page", html.parse("html"))
    return parsed_.select("id", F.explode(html.top_addresses(html.page_addresses(F.col("page")))).alias("address"))
