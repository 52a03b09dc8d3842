"""De-duplication, state, exports, column search, packed helpers."""

import json

import pytest
from pyspark.sql import functions as F

from leadmill.operators import columns, crawl, dedupe, exports, state

LEADS = [
    (1, "https://A.com/", "02 9000 0001"), (2, "www.a.com", "(02) 9000-0001"), (3, "a.com", "02 9000 0002"), (4, None, None), (5, "Not available", ""),
    (6, None, "call me"), (7, None, "no number"), (8, "b.com", None), (9, "http://b.com", "nan"), (10, "c.com", "02 9000 0003"), (11, "c.com/x", "02 9000 0003"),
]


@pytest.fixture
def leads(spark):
    return spark.createDataFrame(LEADS, "lead_id bigint, website string, phone string")


def ids(df):
    return sorted(r.lead_id for r in df.collect())


def test_cascade(leads):
    assert ids(dedupe.with_contact(leads, "website", "phone")) == [1, 2, 3, 6, 7, 8, 9, 10, 11]
    kept = dedupe.cascade(leads, "website", "phone", "lead_id")
    # phones without digits share the empty key; missing phones never merge
    assert ids(kept) == [1, 6, 8, 10]
    assert ids(dedupe.dedupe_by_both(kept, "website", "phone", "lead_id")) == ids(kept)
    assert ids(dedupe.cascade(kept, "website", "phone", "lead_id")) == ids(kept)
    assert ids(dedupe.cascade(leads.repartition(5, "phone"), "website", "phone", "lead_id")) == ids(kept)
    assert ids(dedupe.cascade(leads.limit(0), "website", "phone", "lead_id")) == []


def test_stage_counts(leads):
    got = [tuple(r) for r in dedupe.stage_counts(leads, "website", "phone", "lead_id").collect()]
    assert got == [("input", 11, 0), ("has_contact", 9, 2), ("phone", 6, 3), ("website", 4, 2), ("phone_and_website", 4, 0)]


def test_keep_first_is_reduced_before_the_shuffle(leads):
    plan = dedupe.dedupe_by_phone(leads, "phone", "lead_id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_clean_urls(spark):
    rows = [(1, "https://www.a.com/x"), (2, "http://a.com"), (3, "a.com"), (4, "https://m.facebook.com/a"), (5, "//b.com"), (6, "https://b.com:80/"), (7, None)]
    got = dedupe.clean_urls(spark.createDataFrame(rows, "id bigint, url string"), "url", "id").collect()
    assert sorted(map(tuple, got)) == [("https://b.com:80", "b.com:80", "https://b.com:80/"), ("https://www.a.com", "a.com", "https://www.a.com/x")]


@pytest.fixture
def websites(spark):
    rows = [(1, "https://a", "a", "pending", None), (2, "https://b", "b", "failed", "x"), (3, "https://c", "c", "processing", None), (4, "https://d", "d", "archived", "y"), (5, "https://e", "e", "pending", None)]
    return spark.createDataFrame(rows, "id bigint, url string, domain string, status string, error_message string")


def test_queue(spark, websites):
    assert state.queue_stats(websites).first().asDict() == {"pending": 2, "processing": 1, "completed": 0, "failed": 1, "no_data": 0, "total": 5}
    incoming = spark.createDataFrame([(1, " b "), (2, "f"), (3, "https://a"), (4, "f"), (5, "g.com/x"), (6, " ")], "o bigint, u string")
    fresh = state.new_urls(incoming, "u", "o", websites)
    assert sorted(map(tuple, fresh.collect())) == [(6, "https://f", "f", "pending"), (7, "https://g.com/x", "g.com", "pending")]
    grown = state.merge(websites, fresh, "id")
    assert state.new_urls(incoming, "u", "o", grown).count() == 0
    assert [r.id for r in state.claim(grown, 2).collect()] == [1, 5]
    assert {r.id: r.status for r in state.claimed(grown, 2).collect()}[6] == "pending"
    assert {r.id: r.status for r in state.reset_interrupted(websites).collect()}[3] == "pending"
    again = {r.id: (r.status, r.error_message) for r in state.requeue(websites, ["failed"]).collect()}
    assert again[2] == ("pending", None) and again[4] == ("archived", "y")


def test_merge_last_and_migration(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    up = spark.createDataFrame([(2, "c"), (3, "d")], "k bigint, v string")
    merged = state.merge(base, up, "k")
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, "c"), (3, "d")] == sorted(map(tuple, state.merge(merged, up, "k").collect()))
    seen = spark.createDataFrame([("x", "1", 1), ("x", "2", 2)], "key string, v string, o int")
    assert state.last_by(seen, "key", "v", "o").first().v == "2"
    old = spark.createDataFrame([(None, "2.5 years (897 days)"), (5, "1 years (9 days)"), (None, "odd")], "d int, t string")
    assert [r.d for r in state.migrate_age(old, "d", "t").collect()] == [897, 5, None]
    assert state.order_columns(state.add_columns(old, {"z": "int"}), ["z", "t"]).columns == ["z", "t", "d"]


def test_exports(spark):
    w = spark.createDataFrame([(1, "https://a", "a", "completed", None, 1.5, None, None, None, None, "m\x00d"), (2, "https://b", "b", None, None, None, 3, None, None, 7, None)],
                              "id bigint, url string, domain string, status string, scraped_at timestamp, time_taken_sec double, pages_crawled int, domain_created_at string, domain_expires_at string, domain_age_days int, homepage_markdown string")
    r = spark.createDataFrame([(9, 1, "email 1: ab@c.biz, email 2: cd@e.biz", "1", "x", *[None] * 7)], "id bigint, website_id bigint, email string, phone string, address string, " + ", ".join(f"{c} string" for c in exports.SOCIAL))
    wide = {x.id: x for x in exports.wide(w, r).collect()}
    assert exports.wide(w, r).columns[1:] == exports.WIDE and wide[1]["email 2"] == "cd@e.biz" and wide[2]["email 1"] == "" and wide[2].domain_age_days == "7" and wide[1].pages_crawled == 0
    assert exports.workbook(w, r).where("id = 1").first().homepage_markdown == "md"
    assert sorted(x.email for x in exports.flat_emails(r).collect()) == ["ab@c.biz", "cd@e.biz"]
    record = json.loads(exports.nested(w, r).where("id = 1").first().record)
    assert record["emails"] == ["ab@c.biz", "cd@e.biz"] and record["social_links"]["github"] is None


def test_columns(spark):
    assert columns.keyword_column(["a", " Query "]) == " Query " and columns.keyword_column(["only"]) == "only"
    with pytest.raises(ValueError):
        columns.keyword_column(["a", "b"])
    assert columns.header_row([["x"], ["", "Keyword"]]) == 1 and columns.header_row([["x"]]) is None
    assert columns.url_column_by_name(["a", "LinkedIn"]) == "LinkedIn" and columns.url_column_by_name(["a", "URL"]) == "URL"
    df = spark.createDataFrame([(1, "x", "a.com"), (2, "y", "b.com/c"), (3, None, None)], "o int, name string, home string")
    assert columns.url_column(df, "o") == "home" and columns.url_column(df.drop("home"), "o") is None


def test_crawl(spark):
    page = "<html><body><p>Write to ab@corp.biz<div class='contact'>Call (780) 555-0199<footer class='footer'><p>12 Main Street, Calgary, AB</footer><a href='https://x.com/me'>x</a>"
    pages = spark.createDataFrame(
        [("a", "https://a/", "text/html", page, True, None), ("a", "https://a/pdf", "application/pdf", page.replace("ab@", "zz@"), False, None), ("b", "https://b/", "text/html", "Just a moment", True, "err")],
        "site string, url string, content_type string, html string, is_home boolean, error string")
    scripts = spark.createDataFrame([("a", 'x={phone: "7805550142", address: "5 Side Road"}')], "site string, body string")
    got = {r.site: r for r in crawl.assemble(pages, scripts).collect()}
    a = got["a"]
    assert a.email == "email 1: ab@corp.biz" and a.phone == "+1 (780) 555-0142, +1 (780) 555-0199" and a.twitter == "https://x.com/me"
    assert "12 Main Street, Calgary, AB" in a.address and a.status == "completed" and a.pages_crawled == 2
    assert got["b"].status == "failed" and got["b"].email == ""


def test_hot_key_is_reduced_first(spark):
    df = spark.range(3000).select(F.col("id").alias("lead_id"), F.lit("x").alias("website"), F.lit("1").alias("phone"))
    assert ids(dedupe.cascade(df, "website", "phone", "lead_id")) == [0]


def test_row_numbers_hold_when_adaptive_execution_cuts_ranges(spark):
    from leadmill.operators import state

    known = spark.createDataFrame([(7, "https://known.example")], "id bigint, url string")
    rows = spark.range(5000).select(F.concat(F.lit("https://h"), F.col("id") % 3000, F.lit(".example")).alias("url"), F.col("id").alias("ord"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        fresh = state.new_urls(rows, "url", "ord", known)
        twice = fresh.join(fresh.select("id", F.col("url").alias("again")), "id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert sorted(r.id for r in twice) == list(range(8, 3008)) and all(r.url == r.again for r in twice)


def test_places_within_a_hot_key(spark):
    from leadmill.operators import state

    rows = spark.range(3000).select(F.when(F.col("id") % 10 < 8, F.lit("hot")).when(F.col("id") % 10 == 8, "cold").alias("k"), F.col("id").alias("n"))
    got = state.numbered_within(rows.repartition(5), "k", "n").collect()
    for key in ("hot", "cold", None):
        mine = sorted((r.n, r.place) for r in got if r.k == key)
        assert [p for _, p in mine] == list(range(1, len(mine) + 1)) and mine


def test_addresses_to_fetch(spark):
    homes = crawl.home_addresses(spark.createDataFrame([("a", "a.example/"), ("b", "http://www.b.example")], "site string, url string")).collect()
    assert sorted(map(tuple, homes)) == [("a", 0, "https://a.example"), ("a", 1, "https://www.a.example"), ("b", 0, "http://www.b.example")]
    page = "<a href='/contact-us'>Contact</a><a href='team/contact'>Contact us</a><a href='https://other.example/contact'>Contact</a><a href='/'>Contact</a>" + "".join(f"<script src='/js/{k}.js'></script>" for k in range(7)) + "<script src='/js/0.js'></script>"
    rows = spark.createDataFrame([("a", "https://a.example/", page), ("b", "https://b.example", None)], "site string, url string, html string")
    got = sorted((r.site, r.place, r.url) for r in crawl.pages_to_fetch(rows).collect())
    assert [g[2] for g in got if g[0] == "a"][:2] == ["https://a.example/contact-us", "https://a.example/team/contact"]
    assert len({g[2] for g in got if g[0] == "a"}) == len([g for g in got if g[0] == "a"])
    assert len([g for g in got if g[0] == "b"]) == 9 and all(g[2].startswith("https://b.example/") for g in got if g[0] == "b")
    assert sorted(r.url for r in crawl.scripts_to_fetch(rows).collect()) == [f"https://a.example/js/{k}.js" for k in range(5)]


def test_what_a_run_does_first(spark):
    from leadmill import schemas
    from leadmill.operators import runs

    site = {c.split(" ")[0]: None for c in schemas.WEBSITES.split(", ")}
    result = {c.split(" ")[0]: None for c in schemas.EXTRACTED_RESULTS.split(", ")}
    websites = spark.createDataFrame([{**site, "id": k, "url": f"https://s{k}.example", "domain": f"s{k}.example", "status": s, "error_message": "e"} for k, s in enumerate(["completed", "failed", "no_data", "processing"], 1)], schemas.WEBSITES)
    results = spark.createDataFrame([{**result, "id": 10 + k, "website_id": k, "status": "failed", "email": "", "phone": "+91 88855 51111", "address": ""} for k in (1, 2)], schemas.EXTRACTED_RESULTS)
    incoming = spark.createDataFrame([("s1.example", 1), ("new.example", 2), ("new.example", 3)], "url string, ord int")

    def states(start):
        return {r.id: r.status for r in start.websites.collect()}, {r.id: (r.website_id, r.status) for r in start.results.collect()}, {r.id for r in start.pending.collect()}

    sites, found, pending = states(runs.begin(websites, results, incoming))
    assert sites == {1: "completed", 2: "pending", 3: "pending", 4: "pending", 5: "pending"} and pending == {2, 3, 4, 5}
    assert found == {11: (1, "failed"), 12: (2, "pending"), 13: (5, "pending")}
    sites, found, pending = states(runs.begin(websites, results, incoming, runs.Options(retry=False)))
    assert sites == {1: "completed", 2: "failed", 3: "no_data", 4: "pending", 5: "pending"} and pending == {4, 5}
    sites, found, pending = states(runs.begin(websites, results, incoming, runs.Options(export_only=True)))
    assert sites[2] == "pending" and 5 not in sites and not pending
    again = runs.begin(websites, results, incoming, runs.Options(recheck_existing=True, assume_country="in"))
    assert all(r.phone.startswith("+") for r in again.results.collect())
    assert [r.id for r in runs.exported(again)["wide"].collect()] == [1, 2, 3, 4]


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,3000]", "k8s://host"])
def test_a_cluster_needs_a_shared_folder(master):
    from types import SimpleNamespace

    from leadmill.session import shared_folder

    unset = SimpleNamespace(get=lambda name, default=None: default)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(conf=unset, sparkContext=context))
