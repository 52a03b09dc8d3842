"""Quotas, exact splits, disjoint blocks, shares within one document of the quota, caps on repeats."""

from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from leadmill.llm import mixing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=6), st.integers(1, 20), st.integers(0, 99))
def test_split_is_exact(counts, shards, seed):
    out = mixing.split(np.array(counts), shards, seed)
    assert (out.sum(0) == counts).all() and (out >= 0).all()
    sizes = out.sum(1)
    assert sizes.max() - sizes.min() <= shards.bit_length() + 1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=4), st.integers(1, 70), st.sampled_from([2, 3, 8]))
def test_the_tree_does_not_depend_on_how_it_is_handed_on(counts, shards, fan):
    nodes = [(0, shards, np.array(counts), np.zeros(len(counts), int))]
    while any(h - l > 1 for l, h, _, _ in nodes):
        nodes = [x for l, h, n, s in nodes for x in mixing.grow("m", l, h, n, s, 5, fan)]
    assert (np.array([n for _, _, n, _ in nodes]) == mixing.split(np.array(counts), shards, 5, "m")).all()
    held = np.array([n for _, _, n, _ in nodes])
    assert (np.array([s for _, _, _, s in nodes]) == np.cumsum(held, 0) - held).all()


DOCS = "doc_id bigint, text string, source string, mix string, shard int, copy int, block int"


def build(spark, n=600):
    words = "alpha beta gamma delta one two three four five six".split()
    rows = []
    for k in range(n):
        source = "big" if k % 3 else "small" if k % 2 else None
        rows.append((k, " ".join(words[(k * j) % 10] for j in range(1 + k % 17)), source, "x", 1, 2, 3))
    rows += [(9001, None, "big", "x", 1, 1, 1), (9002, "", "small", "x", 1, 1, 1), (1, "alpha", "big", "x", 1, 1, 1)]
    return spark.createDataFrame(rows, DOCS)


TARGETS = "mix string, source string, target_share double, max_repeats int, budget_ratio double"


def test_mix(spark):
    df = build(spark)
    targets = spark.createDataFrame([("m", "big", 0.5, 2, 0.6), ("m", "small", 0.4, 3, 0.6), ("m", "none", 0.1, 3, 0.6), ("z", "none", 1.0, 1, 0.5), (None, "big", 1.0, 1, 1.0), ("q", "small", None, 1, 1.0)], TARGETS)
    mixed, report = mixing.mix(df, targets, shard_tokens=300)
    rows = mixed.collect()
    by = {(r.mix, r.source): r for r in report.collect()}
    sizes = {r.doc_id: r.n_tokens for r in rows}
    for key in [("m", "big"), ("m", "small")]:
        r = by[key]
        assert abs(r.mixed_tokens - r.quota_tokens) <= max(sizes.values())
        assert sum(x.n_tokens for x in rows if (x.mix, x.source) == key) == r.mixed_tokens
        assert r.most_repeats <= r.max_repeats
    uses = Counter((x.mix, x.doc_id, x.copy) for x in rows if x.doc_id != 1)
    assert max(uses.values()) == 1
    assert by["z", "none"].mixed_tokens == 0 and by["m", "none"].met is False
    assert {x.source for x in rows} == {"big", "small"}
    for shard in {x.shard for x in rows}:
        places = sorted(x.pos for x in rows if x.shard == shard and x.mix == "m")
        assert places == list(range(1, len(places) + 1))
    again = mixing.mix(df.repartition(5), targets, shard_tokens=300)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_short_source_takes_its_cap(spark):
    df = build(spark)
    targets = spark.createDataFrame([("m", "small", 0.9, 2, 1.0), ("m", "big", 0.1, 1, 1.0)], TARGETS)
    r = {x.source: x for x in mixing.mix(df, targets)[1].collect()}["small"]
    assert r.mixed_tokens == 2 * r.source_tokens and not r.met


def test_many_shards_targets_and_groups(spark, monkeypatch):
    """Small bounds give the same mix: no result hangs on them; more targets than any of them are allowed."""
    df = build(spark)
    targets = spark.createDataFrame([(f"m{k % 3}", s, 0.4, 3, 0.7) for k in range(3) for s in ("big", "small")] + [(f"x{k}", f"none{k}", 1.0, 1, 0.5) for k in range(1500)], TARGETS)
    usual = sorted(map(tuple, mixing.mix(df, targets, shard_tokens=200)[0].collect()))
    monkeypatch.setattr(mixing, "FAN", 2)
    monkeypatch.setattr(mixing, "MAX_SENT", 1)
    assert sorted(map(tuple, mixing.mix(df, targets, shard_tokens=200)[0].collect())) == usual
    assert len({r[:2] for r in usual}) > 12
    monkeypatch.setattr(mixing, "GROUP", 7)
    mixed, report = mixing.mix(df, targets, shard_tokens=200)
    largest = max(r[-1] for r in usual)
    for r in report.where("mixed_tokens > 0").collect():
        assert abs(r.mixed_tokens - r.quota_tokens) <= largest
    assert report.count() == 1506


def test_empty(spark):
    df = build(spark).limit(0)
    targets = spark.createDataFrame([("m", "big", 1.0, 1, 1.0)], TARGETS)
    mixed, report = mixing.mix(df, targets)
    assert mixed.count() == 0 and report.collect()[0].mixed_tokens == 0
    assert mixing.mix(build(spark), targets.limit(0))[0].count() == 0
