"""Packed fields: hand-written cases, a plain-split reference on simple fields, edge tables."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from leadmill.operators.packed_fields import split_field, unpack_fields

EMAILS = [
    ("a@x.example", ["a@x.example"]),
    ("<a@x.example>", ["a@x.example"]),
    ("email 1: a@x.example, email 2: b@y.test", ["a@x.example", "b@y.test"]),
    ("mailto:a@x.example | mailto:B@X.example", ["a@x.example", "B@X.example"]),
    ('"Sales; Team, North" <a@x.example>; "Front desk" <b@x.example>', ["a@x.example", "b@x.example"]),
    ("'a@x.example';'b@x.example'", ["a@x.example", "b@x.example"]),
    ("d'oro@x.example und web+leads@x.example", ["d'oro@x.example", "web+leads@x.example"]),
    ("a@x.example a@x.example", ["a@x.example", "a@x.example"]),
    ("a@x.example / / b@x.example,,", ["a@x.example", "b@x.example"]),
    ('"a@x.example", "b@x.example"', ["a@x.example", "b@x.example"]),
    ("Support: a@x.example Bookings: b@x.example", ["a@x.example", "b@x.example"]),
]
PHONES = [
    ("phone 1: 01632-960-471, phone 2: (02) 5550 3489", ["01632-960-471", "(02) 5550 3489"]),
    ("040/555007 38, 030-555070-22", ["040/555007 38", "030-555070-22"]),
    ("(030) 555046-16 (24h)", ["(030) 555046-16"]),
    ("0491-577-023 x739 / +49 40 5550 ext. 56", ["0491-577-023 x739", "+49 40 5550 ext. 56"]),
    ("Call +61 3 5550 3983 Text 0755501702", ["+61 3 5550 3983", "0755501702"]),
    ("T 08.5550.3787\nF 02 5550 1111", ["08.5550.3787", "02 5550 1111"]),
    ('"0491.579.567", "+1 (720) 555 4805"', ["0491.579.567", "+1 (720) 555 4805"]),
    ("+12285556999 +12285556999", ["+12285556999", "+12285556999"]),
    ("030/555063 29 oder 069/555063 29", ["030/555063 29", "069/555063 29"]),
    ("1) 355.555.0082 2) (01632) 960 982", ["355.555.0082", "(01632) 960 982"]),
]
ADDRESSES = [
    ("1 A St, Town; 2 B St, Town |", ["1 A St, Town", "2 B St, Town"]),
    ("Office 1: 1 A St, Office 2: 2 B St, Town", ["1 A St", "2 B St, Town"]),
    ("Head office: 1 A St, Warehouse: 2 B St", ["1 A St", "2 B St"]),
    ("Showroom - 1 A St, Workshop - 2 B St", ["1 A St", "2 B St"]),
    ("(1) 1 A St (2) 2 B St (rear entrance)", ["1 A St", "2 B St (rear entrance)"]),
    ("1) 1 A St; 2) 2 B St", ["1 A St", "2 B St"]),
    ('"""Old Mill"", 1 A St, Town","2 B St"', ['"Old Mill", 1 A St, Town', "2 B St"]),
    ("4/12 A St, Town / 2 B St", ["4/12 A St, Town", "2 B St"]),
    ("1 A St,\nTown 4000", ["1 A St,\nTown 4000"]),
    ("1 A St, Town\n2 B St, Town", ["1 A St, Town", "2 B St, Town"]),
    ("1 A St <br> 2 B St<br>", ["1 A St", "2 B St"]),
    ("1 a st, town, or <br> 2 B St", ["1 a st, town, or", "2 B St"]),
]


@pytest.mark.parametrize(
    ("field", "text", "want"),
    [("email", t, w) for t, w in EMAILS] + [("phone", t, w) for t, w in PHONES] + [("address", t, w) for t, w in ADDRESSES],
)
def test_split(field, text, want):
    assert split_field(field, text) == want


@pytest.mark.parametrize("field", ["email", "phone", "address"])
@pytest.mark.parametrize("text", [None, "", "  \n", "Not available", " n/a ", "-", ",;|", '"'])
def test_nothing_to_give(field, text):
    assert split_field(field, text) in ([], ['"'])


@given(st.lists(st.sampled_from(["a@b.example", "x.y@z.test", "d'oro@q.example"]), max_size=6), st.sampled_from([", ", ";", " | ", "\n", "\t", " "]))
def test_emails_against_plain_split(values, separator):
    assert split_field("email", separator.join(values)) == values


@given(st.text(max_size=200))
def test_any_text_is_read(text):
    for field in ("email", "phone", "address"):
        assert all(v == v.strip() and v for v in split_field(field, text))


def test_long_text():
    assert len(split_field("email", ", ".join(["a@b.example"] * 20000))) == 20000


def test_table(spark):
    schema = "id bigint, email string, phone string, address string, value string, pos string"
    rows = [(1, "a@b.example, a@b.example", None, "1 A St", "clash", "x"), (1, "a@b.example", "", None, None, None), (None, "a@b.example", None, None, None, None)]
    got = sorted(map(tuple, unpack_fields(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted(
        [
            (1, "email", 1, "a@b.example"), (1, "email", 2, "a@b.example"), (1, "address", 1, "1 A St"),
            (1, "email", 1, "a@b.example"), (None, "email", 1, "a@b.example"),
        ],
        key=str,
    )
    assert unpack_fields(spark.createDataFrame([], schema)).count() == 0


def test_long_numbered_lists():
    text = " ".join(f"{k}) {k} Mill Street, Oldtown" for k in range(1, 151))
    assert split_field("address", text) == [f"{k} Mill Street, Oldtown" for k in range(1, 151)]


@pytest.mark.parametrize(
    "text, want",
    [
        ('"john doe"@x.example', ['"john doe"@x.example']),
        ('"Doe, John" <a@x.example>, "b@y.example"', ["a@x.example", "b@y.example"]),
        ('"a@no.example" <a@x.example>', ["a@x.example"]),
        ("a@x.example b@y.example", ["a@x.example", "b@y.example"]),
        ("mailto:a@x.example?subject=b@y.example", ["a@x.example"]),
    ],
)
def test_emails_in_pieces(text, want):
    assert split_field("email", text) == want


@pytest.mark.parametrize("unit", ["'a,", '"a,', "(", "a\n", "1) ", "1 or ", "a@x.example ", "/ ", "[x] ", " ", "12 Mill Street, ", "555 ", "+", "a: ", "\n", ",\n"])
def test_time_is_linear(unit):
    import time

    for field in ("email", "phone", "address"):
        took = []
        for n in (8_000, 32_000):
            text = "x" + unit * (n // len(unit))
            began = time.perf_counter()
            split_field(field, text)
            took.append(time.perf_counter() - began)
        assert took[1] < 12 * took[0] + 0.3, (field, took)
