"""Golden values of the scalar functions, traps included."""

import datetime

import pytest
from pyspark.sql import functions as F

from leadmill.functions import dates, emails, phones, social, status, text, urls


@pytest.fixture
def value(spark):
    def run(expression):
        return spark.range(1).select(expression.alias("v")).first().v

    return run


def test_strip_takes_all_white_space(value):
    assert value(text.py_strip(F.lit("  a b \t\n"))) == "a b"


@pytest.mark.parametrize(("s", "want"), [("x", True), (" NaN ", False), ("", False), (" Not Available ", False), (None, False), ("none", True)])
def test_has_value(value, s, want):
    assert value(text.has_value(F.lit(s).cast("string"))) is want


@pytest.mark.parametrize(("s", "want"), [("Error", True), (" nat", False), ("None", False), (None, False), ("200", True)])
def test_has_result(value, s, want):
    assert value(text.has_result(F.lit(s).cast("string"))) is want


def test_missing_tokens(value):
    assert value(text.nullif_pandas_na(F.lit("N/A"))) is None and value(text.nullif_pandas_na(F.lit("no"))) == "no"


@pytest.mark.parametrize(("s", "want"), [("9:00 AM to 5:00 PM", "9 am–5 pm"), ("9AM - 5 PM", "9AM–5 pm"), (None, ""), (" 24  hours ", "24 hours")])
def test_time_range(value, s, want):
    assert value(text.normalize_time_range(F.lit(s).cast("string"))) == want


def test_timings(value):
    m = lambda **k: F.create_map(*[F.lit(x) for kv in k.items() for x in kv])
    assert value(text.pick_timings(m(Monday="9 AM", Sunday="Closed"), F.lit("Sunday"), F.lit("x"))) == "9 am"
    assert value(text.pick_timings(m(Monday="9 AM", Tuesday="8 AM"), F.lit("Tuesday"), F.lit("x"))) == "8 am"
    assert value(text.pick_timings(m(Monday="9 AM", Tuesday="8 AM"), F.lit("Friday"), F.lit("Open\nnow"))) == "Open now"


@pytest.mark.parametrize(
    ("u", "net", "domain", "root"),
    [
        ("https://WWW.Foo_bar.com:80/a?b", "WWW.Foo_bar.com:80", "foo_bar.com:80", "https://WWW.Foo_bar.com:80"),
        ("//host/x", "host", "host", ""), ("host.com/x", "", "", ""), ("ftp://u@h.org#f", "u@h.org", "u@h.org", "ftp://u@h.org"), ("", "", "", ""),
    ],
)
def test_urls(value, u, net, domain, root):
    assert value(urls.netloc(F.lit(u))) == net and value(urls.bare_domain(F.lit(u))) == domain and value(urls.root_url(F.lit(u))) == root


@pytest.mark.parametrize(("d", "want"), [("facebook.com", True), ("m.facebook.com", True), ("notfacebook.com", False), ("x.com", True), ("wix.com", False)])
def test_platforms(value, d, want):
    assert value(urls.is_platform(F.lit(d))) is want


@pytest.mark.parametrize(("u", "want"), [(' "a.com" ', "https://a.com"), ('""', "https://"), ("null", ""), ("HTTP://a", "HTTP://a"), (None, "")])
def test_probe_url(value, u, want):
    assert value(urls.probe_url(F.lit(u).cast("string"))) == want


@pytest.mark.parametrize(("u", "want"), [("www.x.com", False), ("4.5", True), ("https://a.b", True), ("plain", False), (" ", False)])
def test_looks_like_url(value, u, want):
    assert value(urls.looks_like_url(F.lit(u))) is want


def test_keys_and_social_urls(value):
    assert value(urls.website_key(F.lit(" HTTPS://www.A.com/b// "))) == "a.com/b"
    assert value(urls.clean_social_url(F.lit("https://f.com/profile.php?id=1"))) == "https://f.com/profile.php"
    assert value(urls.registrable(F.lit("HTTPS://www.A.com:80/b"))) == "a.com"


@pytest.mark.parametrize(
    ("e", "want"),
    [
        ("ab@corp.biz", True), ("a@corp.biz", False), ("iconic@corp.biz", False), ("www1@corp.biz", False), ("ab@2x.png", False), ("ab@x.example.com", False),
        ("3e6b0deb414549c8901b5382885e478b@corp.biz", False), ("ab@corp", False), ("ab@corp.b", False), ("u002fab@corp.biz", True), ("noat", False), ("ab@corp.ts", False), (".ab@corp.biz.", True),
    ],
)
def test_email_rules(value, e, want):
    assert value(emails.is_valid(F.lit(e))) is want


def test_email_deny_list_is_a_parameter(value):
    assert value(emails.is_valid(F.lit("ab@example.com"), ["other.com"])) is True


def test_emails_of_text(value):
    assert value(emails.from_text(F.lit("Mail Info@Corp.biz or sales [at] corp [dot] biz, a@b"))) == ["info@corp.biz", "sales@corp.biz"]
    assert value(emails.from_text(F.lit("info@x.com. Please"))) == ["info@x.com", "info@x.com.please"]


def test_labels_round_trip(value):
    found = F.array(*[F.lit(f"u{i}@corp.biz") for i in range(12)])
    label = value(emails.labeled(found))
    assert label.startswith("email 1: u0@corp.biz, ") and label.endswith("email 10: u9@corp.biz")
    assert value(emails.from_labeled(F.lit(label))) == [f"u{i}@corp.biz" for i in range(10)]
    assert value(emails.labeled(F.array().cast("array<string>"))) == "" and value(emails.from_labeled(F.lit(None).cast("string"))) == []


def test_cloudflare(value):
    coded = "2a" + "".join(f"{ord(c) ^ 0x2A:02x}" for c in "me@corp.biz")
    assert value(emails.decode_cloudflare(F.lit(coded))) == "me@corp.biz"
    assert value(emails.decode_cloudflare(F.lit("zz"))) == "" and value(emails.decode_cloudflare(F.lit("2a"))) == ""


@pytest.mark.parametrize(
    ("p", "hint", "want"),
    [
        ("tel: (780) 555-0199", None, "+1 (780) 555-0199"), ("98765 43210", "IN", "+91 98765 43210"), ("0412987345", None, None), ("0412987345", "CA", "+1 (041) 298-7345"),
        ("04035610885", "IN", "+91 40356 10885"), ("0044 20 7946 0000", None, "+442079460000"), ("442079460000", None, None), ("44207946000", None, "+44207946000"),
        ("12345678901", None, None), ("2026080712", None, "+1 (202) 608-0712"), ("+20260807", None, None), ("12", None, None), ("", None, None), ("91 98765 12345", None, "+91 98765 12345"),
    ],
)
def test_phones(value, p, hint, want):
    got = value(phones.clean_phone(F.lit(p), F.lit(hint).cast("string")))
    assert got == want


@pytest.mark.parametrize(("c", "d", "want"), [("in India, Canada", "", "IN"), ("Calgary, AB", "", "CA"), ("so, on it goes", "", "CA"), ("Austin, TX 78701", "", "US"), ("x", "a.ca", "CA"), ("x", "a.in", "IN"), (None, None, None)])
def test_country(value, c, d, want):
    assert value(phones.country_hint(F.lit(c).cast("string"), F.lit(d).cast("string"))) == want


def test_phone_recheck(spark):
    df = spark.createDataFrame([(1, "+91 78055 50199, +1 (780) 555-0199, x12", "CA"), (2, "", None)], "id bigint, phone string, hint string")
    got = {r.id: r.fixed for r in phones.recheck_table(df, "id", "phone", "hint").collect()}
    assert got == {1: "+1 (780) 555-0199, x12", 2: ""}


def test_social(value):
    t = F.lit("see https://www.facebook.com/shop/?a=1 and https://facebook.com/sharer/x https://x.com/me")
    assert value(social.from_text(t, "facebook")) == ["https://www.facebook.com/shop"]
    assert value(social.from_text(t, "twitter")) == ["https://x.com/me"]
    assert value(social.listing_label(F.lit("https://wix.com/a"))) == "Other Social Links"
    assert value(social.listing_label(F.lit("https://youtu.be/a"))) == "YouTube" and value(social.listing_label(F.lit("https://a.org"))) is None


@pytest.mark.parametrize(("c", "want"), [(None, "No Response"), ("Error", "Error"), ("404", "Not Found"), (" 200 ", "OK"), ("418", "HTTP 418"), ("", "Error")])
def test_status_note(value, c, want):
    assert value(status.status_note(F.lit(c).cast("string"))) == want


@pytest.mark.parametrize(
    ("u", "h", "g", "e", "want"),
    [
        ("https://a", 403, 200, None, ("200", "OK", "Yes")), ("https://a", 405, 404, None, ("404", "Not Found", "No")), ("https://a", 399, None, None, ("399", "HTTP 399", "Yes")),
        ("https://a", 400, None, None, ("400", "Bad Request", "No")), ("https://a", None, None, "SSLError", ("Error", "SSL Error", "No")), ("https://a", None, None, "Odd", ("Error", "Error: Odd", "No")), ("", 200, None, None, (None, "No URL", "No")),
    ],
)
def test_probe(value, u, h, g, e, want):
    got = value(status.probe_outcome(F.lit(u), F.lit(h).cast("int"), F.lit(g).cast("int"), F.lit(e).cast("string")))
    assert tuple(got) == want


def test_site_states_and_challenges(value):
    assert value(status.site_status(F.lit(False), F.lit("x"))) == "failed" and value(status.site_status(F.lit(True), F.lit("x"))) == "completed"
    assert value(status.site_status(F.lit(False), F.lit(None).cast("string"))) == "no_data"
    assert value(status.is_challenge(F.lit("Just a MOMENT"), F.lit("u"))) and value(status.is_challenge(F.lit(None).cast("string"), F.lit("x/sgcaptcha"))) and not value(status.is_challenge(F.lit("a"), F.lit("b")))


def test_dates(value):
    now = F.lit("2026-01-02 00:00:00").cast("timestamp")
    assert value(dates.age_days(F.lit("2026-01-01 01:00:00").cast("timestamp"), now)) == 0
    assert value(dates.age_days(F.lit("2027-01-01").cast("timestamp"), now)) == 0
    assert value(dates.as_day(dates.first_date(F.array(F.lit(datetime.datetime(2020, 5, 6, 7)))))) == "2020-05-06"
    assert value(dates.first_date(F.array().cast("array<timestamp>"))) is None
    assert value(dates.legacy_age(F.lit("2.5 years (897 days)"))) == 897 and value(dates.legacy_age(F.lit("x"))) is None
    assert value(dates.duration(F.lit(3605.0))) == "1h 0m 5s" and value(dates.duration(F.lit(65.0))) == "1m 5s" and value(dates.duration(F.lit(0.0))) == "0s"


def test_excel_and_errors(value):
    assert value(text.excel_safe(F.lit("a\x00b\x0bc"))) == "abc"
    assert len(value(text.excel_safe(F.lit("x" * 33000)))) == 32000 + len(text.EXCEL_SUFFIX)
    assert value(text.short_error(F.lit("one\ntwo"))) == "one"


def test_titles_and_reviews(value):
    n = F.lit(None).cast("string")
    assert value(text.title_from(F.lit(" "), n, F.lit("Shop · 4.5"))) == "Shop" and value(text.title_from(n, n, n)) == "Not available"
    assert value(text.first_digits(F.lit("none"), F.lit("1,234 reviews"))) == "1234" and value(text.first_digits(n)) == ""
