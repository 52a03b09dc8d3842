"""HTML pages to facts: one Arrow pass parses a page to a struct, native expressions do the rest.

The parser is the standard library's; unclosed tags end where their parent ends or where an element
that can't be inside them begins. ``parse`` gives links, scripts, JSON-LD texts, blocks with their
class hints and text, Cloudflare codes and the whole text without script, style and template content.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.functions import emails, phones, social
from leadmill.functions.urls import netloc, url_join

#: Words of contact links, of address texts and of what is none.
CONTACT_WORDS = ["contact", "about", "team", "people", "leadership", "staff", "reach", "connect", "impressum", "legal", "touch", "help", "support"]
ADDRESS_WORDS = [
    "complex", "building", "street", "st", "avenue", "ave", "road", "rd",
    "nagar", "dilsukhnagar", "hyderabad", "telangana", "500060", "suite", "ste",
    "floor", "po box", "zip", "postal", "vancouver", "toronto", "london",
    "new york", "bengaluru", "mumbai", "delhi", "chennai", "kolkata", "pune",
    "ahmedabad", "gurgaon", "noida", "sector", "colony", "marg", "chowk",
    "kamala", "croma", "gajam", "india", "usa", "uk", "canada", "san francisco",
]
NOT_ADDRESS = [
    "street-address", "addresslocality", "addressregion", "postalcode", "addresscountry",
    "hours", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
    "dancing street", "huyi", "lorem", "ipsum", "select subject", "submit message",
    "hiring", "support engineer", "leave a message", "ready to help", "explore what we offer",
    "what industries", "can shellx", "helps the clients", "recaptiualize", "metrics",
    "content", "communities", "web-enabled", "strategy", "experience", "blog list", "home blog",
    "categories", "navigation", "menu", "search here", "read more", "solutions engineering",
    "see all solutions", "customer service", "slack connect", "hosting resources", "newsroom",
    "careers investors", "works where your team",
]
NOT_ADDRESS_BLOCK = ["privacy", "terms", "cookie", "copyright", "all rights", "subscribe", "newsletter", "working hours", "weekdays"]
ADDRESS_CLASSES = ["address", "location", "footer", "header", "office", "headquarters"]
PHONE_CLASSES = ["info", "call", "header", "footer", "contact", "phone", "media", "top"]
PHONE_LABELS = ["call", "ph:", "phone", "tel:", "contact"]
NOT_SCRIPT_ADDRESS = ["http", "pop", "react", "window", "null", "undefined", "function", ".png", ".jpg", ".svg", ".css", ".js"]
#: Labels before an address, postcodes, and a number with a street.
ADDRESS_PREFIX = r"(?i)^(our office address|office address|our location|location|address)\s*:?\s*"
POSTCODE = r"\b(?:[A-Za-z]\d[A-Za-z]\s?\d[A-Za-z]\d|\d{5}(?:-\d{4})?)\b"
NUMBER_AND_STREET = (
    r"\b\d{1,6}\s+(?:[A-Z][\w.'\-]*\s+){0,3}(?i:street|st|avenue|ave|road|rd|blvd|boulevard|drive|dr|way|trail|lane|ln|"
    r"court|ct|place|pl|highway|hwy|parkway|pkwy|circle|cir)\b"
)

_LINK = T.StructType([T.StructField("href", T.StringType()), T.StructField("text", T.StringType())])
_BLOCK = T.StructType([T.StructField("tag", T.StringType()), T.StructField("hint", T.StringType()), T.StructField("text", T.StringType())])
PAGE = T.StructType(
    [
        T.StructField("links", T.ArrayType(_LINK)),
        T.StructField("scripts", T.ArrayType(T.StringType())),
        T.StructField("blocks", T.ArrayType(_BLOCK)),
        T.StructField("cfemails", T.ArrayType(T.StringType())),
        T.StructField("ld_phones", T.ArrayType(T.StringType())),
        T.StructField("ld_addresses", T.ArrayType(T.StringType())),
        T.StructField("text", T.StringType()),
    ]
)
_BLOCK_TAGS = frozenset("address div p span li td section footer h4 h5".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style template".split())
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SELF_NESTING_END = {"li": "li", "td": "td", "tr": "tr", "option": "option", "dd": "dd", "dt": "dt"}


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[dict] = []
        self.links: list[dict] = []
        self.scripts: list[str] = []
        self.blocks: list[dict] = []
        self.cfemails: list[str] = []
        self.ld_json: list[str] = []
        self.pieces: list[str] = []
        self.ld: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag in _CLOSES_P and any(e["tag"] == "p" for e in self.stack):
            self._close("p")
        if tag in _SELF_NESTING_END and self.stack and self.stack[-1]["tag"] == tag:
            self._close(tag)
        if "data-cfemail" in a:
            self.cfemails.append(a["data-cfemail"])
        if tag == "script":
            if a.get("src"):
                self.scripts.append(a["src"])
            self.ld = [] if a.get("type") == "application/ld+json" else None
        if tag in _VOID:
            return
        e = {"tag": tag, "from": len(self.pieces), "hint": " ".join([a.get("class", ""), a.get("id", "")]).lower(), "href": a.get("href")}
        if tag in _BLOCK_TAGS:
            e["at"] = len(self.blocks)
            self.blocks.append({"tag": tag, "hint": e["hint"], "text": ""})
        if tag == "a" and e["href"] is not None:
            e["link"] = len(self.links)
            self.links.append({"href": e["href"], "text": ""})
        self.stack.append(e)

    def handle_endtag(self, tag):
        if tag == "script" and self.ld is not None:
            self.ld_json.append("".join(self.ld))
            self.ld = None
        if any(e["tag"] == tag for e in self.stack):
            self._close(tag)

    def _close(self, tag):
        while self.stack:
            e = self.stack.pop()
            self._finish(e)
            if e["tag"] == tag:
                return

    def _finish(self, e):
        said = self.pieces[e["from"] :]
        if "at" in e:
            self.blocks[e["at"]]["text"] = " ".join(said)
        if "link" in e:
            self.links[e["link"]]["text"] = "".join(said)

    def handle_data(self, data):
        if self.ld is not None:
            self.ld.append(data)
        if not any(e["tag"] in _SILENT for e in self.stack) and (s := data.strip()):
            self.pieces.append(s)

    def finish(self):
        self.close()
        while self.stack:
            self._finish(self.stack.pop())


def _walk(obj, found_phones: list[str], found_addresses: list[str]) -> None:
    """Phones and addresses anywhere in a JSON-LD value, without recursion limits."""
    todo = [obj]
    while todo:
        x = todo.pop(0)
        if isinstance(x, list):
            todo += x
        elif isinstance(x, dict):
            kind = x.get("@type")
            if (isinstance(kind, str) and kind in ("PostalAddress", "Place")) or "addressLocality" in x or "streetAddress" in x:
                parts = [x.get(k) for k in ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry")]
                if any(parts):
                    found_addresses.append(", ".join(str(p).strip() for p in parts if p))
            for k, v in x.items():
                if k in ("telephone", "phone", "fax") and isinstance(v, str):
                    found_phones.append(v)
                elif k in ("address", "location") and isinstance(v, str):
                    found_addresses.append(v.strip())
                else:
                    todo.append(v)


def parse_page(html: str | None) -> dict:
    page = _Page()
    try:
        page.feed(html or "")
        page.finish()
    except (AssertionError, ValueError):
        pass  # what was read so far counts
    found_phones: list[str] = []
    found_addresses: list[str] = []
    for content in page.ld_json:
        try:
            _walk(json.loads(content), found_phones, found_addresses)
        except ValueError:
            continue
    return {
        "links": page.links, "scripts": page.scripts, "blocks": page.blocks, "cfemails": page.cfemails,
        "ld_phones": found_phones, "ld_addresses": found_addresses, "text": " ".join(page.pieces),
    }


@F.pandas_udf(PAGE)
def parse(html: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """A page as a struct of its links, scripts, blocks, codes, JSON-LD facts and text."""
    for part in html:
        yield pd.DataFrame([parse_page(h) for h in part], columns=[f.name for f in PAGE.fields])


def page_emails(html: Column, page: Column, bad_domains: list[str] | None = None) -> Column:
    """Sorted distinct addresses: in the text of the page, mailto links and Cloudflare codes."""
    hrefs = F.transform(page["links"], lambda x: x["href"])
    mailto = F.transform(
        F.filter(hrefs, lambda h: h.startswith("mailto:")),
        lambda h: F.lower(F.trim(F.substring_index(F.replace(h, F.lit("mailto:"), F.lit("")), "?", 1))),
    )
    marked = F.transform(F.filter(hrefs, lambda h: F.contains(h, F.lit("/cdn-cgi/l/email-protection#"))), lambda h: F.substring_index(h, "#", -1))
    decoded = F.transform(F.concat(page["cfemails"], marked), lambda x: F.lower(emails.decode_cloudflare(x)))
    extra = F.filter(F.concat(mailto, decoded), lambda e: emails.is_valid(e, bad_domains))
    return F.array_sort(F.array_distinct(F.concat(emails.from_text(html, bad_domains), extra)))


def _has(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(re.sub(r"([.+*?^$(){}|\[\]\\])", r"\\\1", w) for w in words))


def page_phone_candidates(page: Column) -> Column:
    """Candidates: tel links, JSON-LD, and labelled containers with a fitting class.

    The country of each is told from the text of the page, which holds the containers' texts.
    """
    tel = F.transform(
        F.filter(page["links"], lambda x: F.trim(x["href"]).startswith("tel:")),
        lambda x: F.substring_index(F.replace(F.trim(x["href"]), F.lit("tel:"), F.lit("")), "?", 1),
    )
    tags = ["div", "p", "span", "address", "li", "td", "h4", "h5"]
    boxes = F.filter(page["blocks"], lambda b: b["tag"].isin(tags) & _has(b["hint"], PHONE_CLASSES) & _has(F.lower(b["text"]), PHONE_LABELS))
    boxed = F.flatten(F.transform(boxes, lambda b: phones.candidates(b["text"])))
    return F.array_distinct(F.concat(tel, page["ld_phones"], boxed))


def page_phones(df: DataFrame, key: str, page: str, domain: str) -> DataFrame:
    """(key, phone): distinct clean numbers of each page, their country told from the page."""
    hint = phones.country_hint(F.col(f"{page}.text"), F.col(domain))
    each = df.select(key, hint.alias("hint"), F.explode(page_phone_candidates(F.col(page))).alias("phone"))
    return phones.with_clean_phone(each, "phone", "hint", "clean").where("clean is not null").select(key, F.col("clean").alias("phone")).distinct()


def clean_addresses(found: Column) -> Column:
    """Candidates in order, freed of labels, without what is no address and without repeats in other punctuation.

    Of repeats the first in text order stays.
    """
    bare = F.transform(F.array_sort(found), lambda a: F.trim(F.regexp_replace(F.trim(a), ADDRESS_PREFIX, "")))
    fit = F.filter(bare, lambda a: ~F.contains(a, F.lit("?")) & (~F.contains(a, F.lit(":")) | F.contains(F.lower(a), F.lit("office"))) & ~_has(F.lower(a), NOT_ADDRESS))
    keyed = F.transform(fit, lambda a: F.struct(F.regexp_replace(F.lower(a), r"(?U)[^\w]", "").alias("k"), F.trim(F.regexp_replace(a, "^Contact ", "")).alias("a")))
    long = F.filter(keyed, lambda s: F.length(s["a"]) >= 10)
    keys = F.array_distinct(F.transform(long, lambda s: s["k"]))
    return F.transform(keys, lambda k: F.get(F.filter(long, lambda s: s["k"] == k), F.lit(0))["a"])


def page_addresses(page: Column) -> Column:
    """Addresses of a page: JSON-LD, blocks with a fitting class, and any block with the form of an address."""
    def fits(b: Column) -> Column:
        return F.length(b["text"]).between(15, 250) & ~_has(F.lower(b["text"]), NOT_ADDRESS_BLOCK) & _has(F.lower(b["text"]), ADDRESS_WORDS)

    hinted = F.filter(page["blocks"], lambda b: b["tag"].isin("address", "div", "p", "span", "li") & _has(b["hint"], ADDRESS_CLASSES) & fits(b))
    formed = F.filter(
        page["blocks"],
        lambda b: b["tag"].isin("address", "div", "p", "span", "li", "td", "section", "footer")
        & fits(b) & ~_has(F.lower(b["text"]), NOT_ADDRESS) & (b["text"].rlike(POSTCODE) | b["text"].rlike(NUMBER_AND_STREET)),
    )
    text = lambda b: F.trim(F.regexp_replace(b["text"], ADDRESS_PREFIX, ""))
    return clean_addresses(F.concat(page["ld_addresses"], F.transform(hinted, text), F.transform(formed, text)))


def top_addresses(found: Column, most: int = 3) -> Column:
    """The longest addresses, ties in text order."""
    ranked = F.array_sort(F.transform(found, lambda a: F.struct((-F.length(a)).alias("n"), a.alias("a"))))
    return F.slice(F.transform(ranked, lambda s: s["a"]), 1, most)


def script_addresses(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r'(?i)(?:location|address)\s*:\s*"([^"]{3,120})"'), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda a: ~_has(F.lower(a), NOT_SCRIPT_ADDRESS)), lambda a: F.trim(a))))


def contact_links(df: DataFrame, key: str, page: str, base: str, most: int = 10) -> DataFrame:
    """(key, place, contact_url): internal links that speak of contacts, once each, in page order."""
    links = df.select(key, base, F.posexplode(F.col(f"{page}.links")).alias("at", "x"))
    full = links.select(key, base, "at", F.col("x.href").alias("href"), F.col("x.text").alias("said"), url_join(base, "x.href").alias("url"))
    strip = lambda c: F.regexp_replace(c, "/+$", "")
    kept = full.where((netloc(F.col("url")) == netloc(F.col(base))) & (_has(F.lower("said"), CONTACT_WORDS) | _has(F.lower("href"), CONTACT_WORDS)) & (strip("url") != strip(base)))
    each = kept.groupBy(key, "url").agg(F.min("at").alias("at"))
    # the links of one page are few; the sort is within a page
    ranked = each.groupBy(key).agg(F.slice(F.array_sort(F.collect_list(F.struct("at", "url"))), 1, most).alias("l"))
    return ranked.select(key, F.posexplode("l").alias("place", "x")).select(key, (F.col("place") + 1).alias("place"), F.col("x.url").alias("contact_url"))


def script_urls(page: Column) -> Column:
    """The first five external scripts that may hold data."""
    kept = F.filter(page["scripts"], lambda s: F.contains(s, F.lit(".js")) | F.contains(s, F.lit("static")) | F.contains(s, F.lit("chunks")))
    return F.slice(kept, 1, 5)


def page_social(html: Column, page: Column, platform: str) -> Column:
    """Links of a platform in the text, and whole links of the page that match."""
    # a link without a scheme has the page's; any other relative link leads to the page's own host
    full = F.transform(page["links"], lambda x: F.when(x["href"].startswith("//"), F.concat(F.lit("https:"), x["href"])).otherwise(x["href"]))
    hrefs = F.filter(full, lambda h: h.rlike(social.PATTERNS[platform]))
    whole = F.filter(F.transform(hrefs, social.clean_social_url), social.kept)
    return F.array_sort(F.array_distinct(F.concat(social.from_text(html, platform), whole)))


class _Markdown(HTMLParser):
    """h1-h6, p, br, a, b, strong, i, em, li, blockquote, pre and tables' cells; everything else is its text."""

    SKIP = frozenset("script style svg noscript iframe template head".split())
    BREAKS = frozenset("p div section article header footer ul ol table tr blockquote pre main nav aside h1 h2 h3 h4 h5 h6".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0
        self.hrefs: list[tuple[str, int]] = []

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skip += 1
        elif self.skip:
            return
        elif tag == "br":
            self.out.append("\n")
        elif tag in self.BREAKS:
            self.out.append("\n\n" + ("#" * int(tag[1]) + " " if re.fullmatch("h[1-6]", tag) else "> " if tag == "blockquote" else ""))
        elif tag == "li":
            self.out.append("\n* ")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag in ("td", "th"):
            self.out.append(" | ")
        elif tag == "a":
            self.hrefs.append((dict(attrs).get("href") or "", len(self.out)))

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif self.skip:
            return
        elif tag in self.BREAKS:
            self.out.append("\n\n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "a" and self.hrefs:
            href, at = self.hrefs.pop()
            said = "".join(self.out[at:]).strip()
            del self.out[at:]
            self.out.append(f"[{said}]({href})" if said and href else said)

    def handle_data(self, data):
        if not self.skip:
            self.out.append(re.sub(r"\s+", " ", data))


def to_markdown(html: str | None) -> str:
    """A documented part of Markdown; runs of blank lines become one."""
    if not html:
        return ""
    reader = _Markdown()
    reader.feed(html)
    reader.close()
    lines = [line.strip() for line in "".join(reader.out).splitlines()]
    kept = [line for k, line in enumerate(lines) if line or (k and lines[k - 1])]
    return "\n".join(kept).strip()


@F.pandas_udf(T.StringType())
def markdown(html: pd.Series) -> pd.Series:
    return html.map(to_markdown)
