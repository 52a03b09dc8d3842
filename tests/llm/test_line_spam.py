"""Line shapes: kinds of cases, honest look-alikes, edge tables."""

import pytest

from leadmill.llm import line_spam

PHRASES = ["best plumber Oldtown", "plumber Oldtown prices", "cheap plumber Newtown", "24 hour plumber", "plumber near me"] * 8
PROSE = "We look after the pipes of the town, and you can call us on any day of the week if something breaks. "
CASES = {
    "commas": ", ".join(PHRASES),
    "lines": "\n".join(PHRASES),
    "spaces": " ".join(PHRASES).lower(),
    "dashes": " - ".join(PHRASES),
    "same": ("Plumber Oldtown! " * 60).strip(),
    "scrambled": "Plumber best Oldtown plumber. Cheap plumber Newtown plumber? Prices plumber Oldtown day. " * 8,
    "in towns": "Plumber in Oldtown " * 40,
    "tags": " ".join(["#sale", "#plumberoldtown", "#giftidea", "#newin"] * 10),
    "urls": "\n".join(f"https://h{k}.example/p/{k}" for k in range(20)),
    "links": "\n".join(f"* [plumber {k}](https://h{k}.example/{k})" for k in range(20)),
    "anchors": " ".join(f'<a href="/plumber-{k}">plumber {k}</a>' for k in range(20)),
    "names": "\n".join(f"Abc Plumbing Shop - visit site (abc{k}.example)" for k in range(20)),
    "products": " ; ".join(["buy white valve SKU123", "12mm pump", "sale brass hose"] * 10),
    "behind prose": PROSE + "\n\n" + "\n".join(PHRASES),
    "foreign prose before": "雨の日でも作業できますので、お気軽にご相談ください。\n" + "\n".join(PHRASES),
}
HONEST = {
    "prose": PROSE * 5,
    "no stops": (PROSE * 5).replace(",", "").replace(".", ""),
    "short list": PROSE * 3 + "\n\n" + "\n".join(f"* {p}" for p in PHRASES[:5]),
    "contact": "Abc Plumbing\n12 Old Road, Oldtown VIC 3000\nTel: 02 5550 1111\nEmail: a@b.example\nMon - Fri: 9:00 - 17:00",
    "stray run": PROSE + "\n" + "x" * 5000,
    "rules": PROSE + "\nRef " + "=" * 3000,
    "review": "good value friendly people",
    "foreign": "हमारी दुकान पुराने स्टेशन के पीछे है। " * 6,
    "directory": "Listed since 1988, last confirmed in June. Opening times vary around public holidays, so call ahead.",
    "empty": "",
    "blank": " \n\t ",
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    assert line_spam.is_case(CASES[name])


@pytest.mark.parametrize("name", HONEST)
def test_honest(name):
    assert not line_spam.is_case(HONEST[name])


def test_table(spark):
    rows = [(1, CASES["commas"], "x"), (2, HONEST["prose"], None), (3, None, "x"), (4, CASES["links"], "x"), (1, CASES["commas"], "x"), (None, CASES["tags"], "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, id string")
    assert sorted((r.doc_id for r in line_spam.find_line_spam(df).collect()), key=str) == [1, 1, 4, None]
    assert line_spam.find_line_spam(df.limit(0)).count() == 0


def test_long_text():
    assert line_spam.is_case(", ".join(PHRASES * 2000)) and not line_spam.is_case(PROSE * 20000)
