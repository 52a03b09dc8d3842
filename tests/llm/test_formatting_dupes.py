"""Canonical keys, Bloom filters without false negatives, and copies against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadmill.llm import formatting_dupes as fd

SCHEMA = "lead_id bigint, Website string, `Mobile Number` string, key string, hash string, n string"
ROWS = [
    (1, "https://www.A-b.example/home/", "+61 (2) 5550-1111", "x", "x", "x"),
    (2, "<A‑B.EXAMPLE/HOME>", "61.2.5550.1111", None, None, None),
    (3, "61 2 5550 1111", " http://a_b.example/home", None, None, None),
    (4, "a-b.example/home2", "61 2 5550 1111", None, None, None),
    (5, "c.example", "02 5550 1111, 03 5550 2222", None, None, None),
    (6, "c.example​", "0355502222 / 02 5550 1111;", None, None, None),
    (7, "c.example", "02 5550 1111", None, None, None),
    (8, None, "02 5550 1111", None, None, None),
    (9, "c.example", " NOT  available ", None, None, None),
    (10, "", "", None, None, None),
    (11, "-", "+", None, None, None),
    (12, "()", "--", None, None, None),
    (5, "c.example", "02 5550 1111, 03 5550 2222", None, None, None),
    (13, "Not available", "not available", None, None, None),
    (14, "d.example/" + "p" * 50000, "02 5550 1111", None, None, None),
    (15, "D.example/" + "P" * 50000, "(02) 5550 1111", None, None, None),
]
WANT = sorted([(1, 2), (1, 3), (5, 6), (11, 12), (14, 15)])


@pytest.mark.parametrize("bits", [None, fd.MIN_BITS])
def test_copies(spark, bits, monkeypatch):
    if bits:
        monkeypatch.setattr(fd, "MAX_BITS", bits)
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(map(tuple, fd.copies(df, "lead_id", "Website", "Mobile Number").collect()))
    assert got == WANT
    again = fd.copies(df.repartition(7), "lead_id", "Website", "Mobile Number")
    assert sorted(map(tuple, again.collect())) == WANT


def test_collapse_counts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = dict(map(tuple, fd.collapse(df, "lead_id", "Website", "Mobile Number").collect()))
    assert got == {1: 3, 4: 1, 5: 3, 7: 1, 11: 2, 14: 2}


def test_records_without_both_fields_are_singletons(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(map(tuple, fd.collapse_all(df, "lead_id", "Website", "Mobile Number").collect()))
    assert got == sorted({1: 3, 4: 1, 5: 3, 7: 1, 8: 1, 9: 1, 10: 1, 11: 2, 13: 1, 14: 2}.items())
    assert sum(n for _, n in got) == len(ROWS)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert fd.copies(df, "lead_id", "Website", "Mobile Number").count() == 0
    assert fd.collapse(df, "lead_id", "Website", "Mobile Number").count() == 0


def test_hot_group(spark):
    df = spark.range(3000).select(
        F.col("id").alias("lead_id"),
        F.when(F.col("id") % 3 == 0, "hot.example").otherwise(F.concat(F.lit("h"), "id", F.lit(".example"))).alias("Website"),
        F.lit("02 5550 1111").alias("Mobile Number"),
    )
    got = fd.copies(df, "lead_id", "Website", "Mobile Number")
    assert got.count() == 999 and {r.first_id for r in got.collect()} == {0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=60), st.integers(0, 6))
def test_places_stay_in_the_range(values, power):
    bits, ranges = fd.MIN_BITS << power, 1 << power
    hashes = np.array(values, np.int64)
    own = bits // ranges
    for p in fd.filter_places(hashes, bits, ranges):
        assert (p // own == fd.range_of(hashes, ranges)).all()


@pytest.mark.parametrize("range_rows", [fd.RANGE_ROWS, 500])
def test_filter_misses_no_repeat_and_spares_singles(spark, range_rows, monkeypatch):
    monkeypatch.setattr(fd, "RANGE_ROWS", range_rows)
    df = spark.range(21000).select(F.xxhash64(F.col("id") % 20000).alias("hash")).repartition(6)
    bits = fd.filter_bits(21000)
    ranges = fd.ranges_of(21000, bits)
    assert (ranges > 1) == (range_rows == 500)
    bitmap = fd.repeat_filter(df, bits, 21000)
    hashes = np.array([r.hash for r in df.collect()], np.int64)
    unique, counts = np.unique(hashes, return_counts=True)
    hit = fd.has_bits(bitmap, fd.filter_places(unique, bits, ranges))
    assert hit[counts > 1].all() and hit[counts == 1].mean() < 0.02


def test_filter_beyond_its_size_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(fd, "MAX_BITS", fd.MIN_BITS)
    monkeypatch.setattr(fd, "RANGE_ROWS", 1000)
    df = spark.range(60000).select(F.col("id").alias("lead_id"), F.concat(F.lit("h"), F.col("id") % 40000, F.lit(".example")).alias("Website"), F.lit("02 5550 1111").alias("Mobile Number"))
    assert fd.copies(df, "lead_id", "Website", "Mobile Number").count() == 20000
