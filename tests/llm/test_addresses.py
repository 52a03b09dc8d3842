"""Parsing, typing errors, and pairs against brute force over buildings known by construction."""

import itertools
import random

import pytest

from leadmill.llm import addresses
from leadmill.llm.addresses import Gazetteer, buildings, deletions, one_error, parse_address, same_building

TOWNS = [("Oldtown", "Victoria", "VIC", "3000"), ("Newbridge", "Oregon", "OR", "65735"), ("Highcombe", "Devon", "DEV", "NR18 7DQ"), ("Kindholm", "Manitoba", "MB", "R4E 2R0")]
PLACES = Gazetteer(TOWNS)
SCHEMA = "id bigint, address string, building string, name string, place string"
SAME = [
    "12 St Harrow Street, Oldtown VIC 3000", "unit 4, 12 saint harrow st., oldtown", "4/12 St. Harrow Str Oldtown 3000 Australia",
    "Victoria, Oldtown 3000, St Harrow Street, No 12", "St Harrow St 12, 3000 Oldtown, VIC", "No. 12, St Harrow Street, Oldtown - 3000 (rear entrance)",
    "Quay Building, 12 St Harrow Street, VIC 3000", '"Lantern Court", Level 3, 12 SAINT HARROW STREET, OLDTOWN, AU', "12 St Harrow Street,\nOdltown", "Suite #26 12 St Harrow Street Oldtown VIC - ground floor",
]
OTHER = ["12 St Harrow Road, Oldtown VIC 3000", "13 St Harrow Street, Oldtown", "12 St Harrow Street, Newbridge OR 65735", "12 Harrow Street, Oldtown", "12/4 St Harrow Street, Oldtown"]


@pytest.mark.parametrize("text", SAME)
def test_same(text):
    assert parse_address(text, PLACES) == ("oldtown", "12", "street", "saint", "harrow")


@pytest.mark.parametrize("text", OTHER)
def test_other(text):
    got = parse_address(text, PLACES)
    assert got is not None and got != ("oldtown", "12", "street", "saint", "harrow")


@pytest.mark.parametrize("text", ["", "-", "Oldtown 3000", "12 Harrow Street", "Harrow Street, Oldtown", "12", "12 street, Oldtown", "x" * 20000])
def test_nothing(text):
    assert parse_address(text, PLACES) is None


def test_one_error_against_variants():
    rng = random.Random(1)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    for a, b in itertools.product(words, words):
        if one_error(a, b):
            assert deletions(a) & deletions(b)


def brute(rows):
    found = set()
    keys = {}
    for i, text in rows:
        for part in (text or "").split(" | "):
            b = parse_address(part, PLACES)
            if b:
                keys.setdefault(b, set()).add(i)
    for ids in keys.values():
        found |= {(a, b) for a in ids for b in ids if a < b}
    return sorted(found)


def test_pairs_against_brute_force(spark):
    rows = list(enumerate(SAME + OTHER)) + [(50, SAME[0] + " | " + OTHER[0]), (51, SAME[0] + " | " + OTHER[0]), (52, None), (53, "Not available"), (54, ""), (0, SAME[0])]
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)
    places = spark.createDataFrame([(*t, "AU") for t in TOWNS], "locality string, region_name string, region_code string, postcode string, country string")
    assert sorted(map(tuple, same_building(df, places).collect())) == brute(rows)
    assert same_building(df.limit(0), places).count() == 0
    assert same_building(df, places.limit(0)).count() == 0


def test_typing_errors(spark):
    rows = [(k, "5 Brambling Lane, Newbridge OR 65735") for k in range(10)] + [(20, "5 Bramblnig Lane, Newbridge"), (21, "5 Brambing Ln, 65735"), (22, "5 Bramblling Lane, Newbrigde OR")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    places = spark.createDataFrame([(*t, "AU") for t in TOWNS], "locality string, region_name string, region_code string, postcode string, country string")
    assert same_building(df, places).count() == 13 * 12 // 2


PLACES_SCHEMA = "locality string, region_name string, region_code string, postcode string, country string"


def classes(spark, texts):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    places = spark.createDataFrame([(*t, "AU") for t in TOWNS], PLACES_SCHEMA)
    return {r.id: r.building for r in buildings(df, places).collect()}


def test_names_as_frequent_stay_apart(spark):
    found = classes(spark, [f"{n} {name} Street, Oldtown" for name in ("Harlow", "Harrow") for n in (1, 2, 3)])
    assert len(set(found.values())) == 6


def test_a_town_s_own_street_is_not_corrected(spark):
    texts = [f"{n} Mill Street, Oldtown" for n in range(1, 30)] + ["40 Hill Street, Newbridge", "5 Hill Street, Newbridge", "40 Mill Street, Newbridge", "7 Millt Street, Oldtown"]
    found = classes(spark, texts)
    assert found[29] == "newbridge|40|street||hill" and found[30] == "newbridge|5|street||hill" and found[31] == "newbridge|40|street||mill"
    assert found[32] == found[6]


@pytest.mark.parametrize(
    "text, want",
    [
        ("12 Martin Luther King Drive, Oldtown", ("oldtown", "12", "drive", "", "martin luther king")),
        ("12 5th Avenue, Oldtown", ("oldtown", "12", "avenue", "", "5th")),
        ("12 6th Ave Oldtown VIC", ("oldtown", "12", "avenue", "", "6th")),
        ("12 Oak Hill Road, Oldtown", ("oldtown", "12", "road", "", "oak hill")),
        ("12 Oak Hill, Oldtown", ("oldtown", "12", "hill", "", "oak")),
        ("10450 Harrow Street, Oldtown VIC 3000", ("oldtown", "10450", "street", "", "harrow")),
        ("3000 Harrow Street, Oldtown VIC", ("oldtown", "3000", "street", "", "harrow")),
        ("3000 Harrow Street, Oldtown VIC 3000", ("oldtown", "3000", "street", "", "harrow")),
        ("12 Broadway, Oldtown", ("oldtown", "12", "", "", "broadway")),
        ("12 Broadway Oldtown VIC 3000", ("oldtown", "12", "", "", "broadway")),
        ("Lindenstr. 12, 3000 Oldtown", ("oldtown", "12", "", "", "lindenstraße")),
        ("Lindenstraße 12, Oldtown", ("oldtown", "12", "", "", "lindenstraße")),
        ("12 rue des Lilas, 3000 Oldtown", ("oldtown", "12", "rue", "", "des lilas")),
        ("Calle Mayor 12, Oldtown", ("oldtown", "12", "calle", "", "mayor")),
        ("PO Box 12, Oldtown", None),
        ("Harrow Street, 99999 Oldtown", None),
    ],
)
def test_streets(text, want):
    assert parse_address(text, PLACES) == want


def test_towns_of_several_words():
    places = Gazetteer([("Port Harrow East", "Victoria", "VIC", "3001"), ("St Agnes", "Victoria", "VIC", "3002")])
    assert parse_address("12 Mill Street Port Harrow East", places) == ("port harrow east", "12", "street", "", "mill")
    assert parse_address("12 Mill Court St Agnes", places) == ("st agnes", "12", "court", "", "mill")


def test_hot_building_in_parts(spark, monkeypatch):
    monkeypatch.setattr(addresses, "PAIR_ROWS", 7)
    df = spark.createDataFrame([(i, "5 Mill Street, Oldtown", None, None, None) for i in range(60)], SCHEMA)
    places = spark.createDataFrame([(*t, "AU") for t in TOWNS], PLACES_SCHEMA)
    assert sorted(map(tuple, same_building(df, places).collect())) == list(itertools.combinations(range(60), 2))
