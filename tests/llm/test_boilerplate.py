"""Body lines of hand-made pages; classes; brute-force blocks; edge tables."""

import random

import pytest
from pyspark.sql import functions as F

from leadmill.llm import boilerplate
from leadmill.llm.residue import blocks_of, is_chrome

PAGE = """We use cookies to improve your visit.
OK, got it

[Home](/home)
[Contact](/contact)

Home > Services > Oldtown

# Baker · Oldtown

Our cookies are baked each morning, and the jar by the till is for everyone.

* [Rye rolls](/rye): We bake them on Monday.
* Oat bars

## What we do

| Service | From |
| --- | --- |
| rolls | $5 |

Advertisement
[Compare quotes](/ads/1)

Tags: rolls, bread

### Latest news
* Meet the team
* Five signs you need help

Newsletter
Never miss monthly offers by email.
Subscribe

**Find us**
12 Harrow Street, Oldtown VIC 3000
Tel: 02 5550 1111

### About us
Oldtown Bakery is your local baker and more.

© 2020 Oldtown Bakery. All rights reserved.
[Privacy policy](/p) | [Sitemap](/s)

Oldtown Bakery Co 2016"""
BODY = {9, 11, 13, 14, 16, 18, 19, 20}
SCHEMA = "page_table string, id bigint, host string, text string, token string, pool string"


def test_body_lines(spark):
    rows = [("websites", 1, "a.example", PAGE, "x", "x"), ("websites", 1, "a.example", PAGE, "x", "x"), ("extracted_results", 1, None, PAGE, None, None)]
    rows += [("websites", 2, "b.example", None, "", ""), ("websites", 3, "b.example", "", "", ""), ("websites", 4, "b.example", " \n ", "", ""), ("websites", 5, "b.example", "404 Not Found", "", ""), ("websites", 6, "b.example", "[Home](/home)", "", "")]
    got = sorted((r.page_table, r.id, r.line_no) for r in boilerplate.body_lines(spark.createDataFrame(rows, SCHEMA)).collect())
    want = [("websites", 1, n) for n in BODY] * 2 + [("extracted_results", 1, n) for n in BODY]
    assert got == sorted(want)


def test_against_blocks(spark):
    pages = [PAGE, PAGE.replace("Oldtown", "Newbridge"), "Only one line of the body, and no more."]
    rows = [("websites", k, f"h{k}.example", t, "", "") for k, t in enumerate(pages)]
    want = {(k, n) for k, t in enumerate(pages) for b in blocks_of(t) if not is_chrome(b) for n, _ in b}
    got = {(r.id, r.line_no) for r in boilerplate.body_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_a_class_carries_its_verdict(spark):
    chrome = "Newsletter\nWe write once a season to all who bake.\nSubscribe"
    alone = "We write once a season to all who bake."
    pages = [f"Page {k} tells of bread and of butter too.\n\n{chrome}" for k in range(9)] + [f"Last page tells of bread.\n\n{alone}"]
    rows = [("websites", k, "a.example", t, "", "") for k, t in enumerate(pages)]
    got = {(r.id, r.line_no) for r in boilerplate.body_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(k, 1) for k in range(10)}
    found = boilerplate.page_templates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert any(r.class_support == 9 and r.class_size >= 2 for r in found)


def test_pools_and_support_do_not_move_with_the_crawl(spark):
    chrome = "Newsletter\nWe write once a season to all who bake.\nSubscribe"
    pages = [f"Page {k} tells of bread and of butter too.\n\n{chrome}" for k in range(5)] + ["Last page tells of bread.\n\nWe write once a season to all who bake."]
    few = [("websites", k, "a.example", t, "", "") for k, t in enumerate(pages)]
    # a.example has less than 1 % of the larger crawl, in which the same line is the content of other hosts
    many = few + [("websites", 100 + k, f"h{k}.example", f"We write once a season to all who bake.\n\nShop {k} sells rolls.", "", "") for k in range(1000)]

    def kept(rows):
        return {(r.id, r.line_no) for r in boilerplate.body_lines(spark.createDataFrame(rows, SCHEMA)).collect() if r.id < 100}

    assert kept(few) == kept(many) == {(k, 1) for k in range(6)}


def test_recurrence_decides_without_listed_words(spark):
    foot = "Zum Wohle aller Imker im Tal seit jeher.\nGestiftet vom Bund der Waben."
    shared = "| Sorte | Preis |\n| --- | --- |"
    pages = [f"Honig Nummer {k} schmeckt nach Linde.\n\n{shared}\n| Glas {k} | {k} |\n| Fass {k} | {k}0 |\n\n{foot}" for k in range(6)]
    rows = [("websites", k, "imker.example", t, "", "", f"imker.example/{k}") for k, t in enumerate(pages)]
    # five visits of one page are one page: its body is kept
    rows += [("websites", 10 + k, "one.example", f"{foot}\n\nBesuch {k}.", "", "", "one.example") for k in range(5)]
    df = spark.createDataFrame(rows, SCHEMA + ", page string")
    got = {(r.id, r.line_no) for r in boilerplate.body_lines(df).collect()}
    assert got == {(k, n) for k in range(6) for n in (1, 3, 4, 5, 6)} | {(10 + k, n) for k in range(5) for n in (1, 2, 4)}


def test_empty_and_long(spark):
    assert boilerplate.body_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "\n\n".join(f"Line {k} tells of bread and butter." for k in range(20000))
    df = spark.createDataFrame([("websites", 1, "a.example", long, "", "")], SCHEMA)
    assert boilerplate.body_lines(df).count() == 20000


def planted_hosts(hosts: int, pages: int, seed: int):
    """Pages of hosts in a language no list knows: (rows, body line numbers). Each host has a menu, a notice and a foot on all
    pages, a sidebar in one section, and an optional band; bodies vary, and a table's head recurs in them."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ka", "lu", "mo", "ri", "te", "su", "vo", "ny"]) for _ in range(rng.randint(1, 3)))
    say = lambda n: " ".join(word() for _ in range(n))
    rows, body = [], set()
    for h in range(hosts):
        menu, notice, foot = [say(1) for _ in range(5)], [say(9), say(2)], [say(6), say(8), say(4)]
        side, band, head = [say(2) for _ in range(4)], [say(7)], [f"| {say(1)} | {say(1)} |", "| --- | --- |"]
        for k in range(pages):
            i = h * 1000 + k
            blocks = [(menu, False), (notice, False)]
            if k % 10 < 6:
                blocks.append((band, False))
            blocks += [([say(rng.randint(3, 15)) for _ in range(rng.randint(1, 3))], True) for _ in range(rng.randint(2, 5))]
            if k % 2:
                blocks.append((head + [f"| {say(1)} | {k} |" for _ in range(4)], True))
            section = "kalu" if k % 3 == 0 else None
            if section:
                blocks.append((side, False))
            blocks.append((foot, False))
            at, lines = 0, []
            for block, mine in blocks:
                body |= {(i, at + n + 1) for n in range(len(block))} if mine else set()
                lines += [*block, ""]
                at += len(block) + 1
            rows.append(("websites", i, f"h{h}.example", "\n".join(lines), f"h{h}.example/{section}/{k}", section))
    return rows, body


def test_templates_decide_without_any_word_list(spark, monkeypatch):
    import leadmill.llm.residue as residue

    rows, body = planted_hosts(4, 30, 3)
    df = spark.createDataFrame(rows, "page_table string, id bigint, host string, text string, page string, section string")
    # the plan is made here, in this process: chrome flags are taken off behind the parse
    real = boilerplate.parse
    monkeypatch.setattr(boilerplate, "parse", lambda *a: real(*a).withColumn("chrome", F.transform("chrome", lambda x: F.lit(False))))
    assert boilerplate.parse is not residue.parse
    got = {(r.id, r.line_no) for r in boilerplate.body_lines(df).collect()}
    assert len(got & body) >= 0.98 * len(body) and len(got & body) >= 0.98 * len(got)
    # without the deduced templates every line stays
    monkeypatch.setattr(boilerplate, "fixed_blocks", lambda pages: pages.limit(0).select("row", F.lit(0).alias("block")))
    rest = {(r.id, r.line_no) for r in boilerplate.body_lines(df).collect()}
    assert len(body) < 0.75 * len(rest)


def test_classes_are_nested_and_ordered(spark):
    pages = []
    for k in range(12):
        side = "side one\nside two\n\n" if k < 8 else ""
        # two lines whose order changes from page to page are no class of a template
        loose = "loose one\nloose two\n\n" if k % 2 else "loose two\nloose one\n\n"
        pages.append(("websites", k, "a.example", f"top\n\n{side}own {k} text\n\n{loose}bottom", f"a.example/{k}", None))
    df = spark.createDataFrame(pages, "page_table string, id bigint, host string, text string, page string, section string")
    parsed = boilerplate.read_pages(df).where("record is null")
    found = boilerplate.deduced(parsed.select("row", "host", "section", "page", "lines", "blocks"))
    got = sorted(((r.n, r.root, r.valid, r.slot if r.valid else None) for r in found.collect()), key=str)
    # top and bottom are the root, the side class is nested in the slot behind top
    assert got == sorted([(12, True, True, 0), (12, True, True, 3), (8, False, True, 1), (8, False, True, 1), (12, True, False, None), (12, True, False, None)], key=str)


@pytest.mark.parametrize("words", [3, 60])
def test_a_notice_is_chrome_at_any_length(spark, words):
    notice = "We use cookies to count visits" + " and to remember what you chose" * words + "."
    df = spark.createDataFrame([("websites", 1, "a.example", f"{notice}\n\nOur rolls are baked each morning, and you can order.", "", "")], SCHEMA)
    assert [(r.id, r.line_no) for r in boilerplate.body_lines(df).collect()] == [(1, 3)]
