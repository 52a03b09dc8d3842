"""Mixing sources to target weights, in tokens, with capped repeats and a report of the shares reached.

The budget of a mix is a part of the tokens of the whole corpus. A source's quota is its share of
the budget, or its tokens times its cap on repeats if that is less; shortfalls are reported and
not given to other sources. A quota is taken as whole copies of the source and one partial copy.

Each source is cut into blocks of about BLOCK_PART of a shard by a hash of the document, so the number of blocks grows with the
source. A partial copy takes blocks in a permuted order until the quota is reached, and of the block at the cut the documents
up to the one nearest to the quota. A splitting tree then divides the exact block counts of all sources among the output
shards: at each node the left half's counts are drawn from the multivariate hypergeometric distribution, so that every shard
is a fair sample of the mix without any global shuffle of rows. Shards draw disjoint runs of each source's permuted blocks and
shuffle locally.

Scale: targets, blocks, copies, tree and runs are tables of the cluster; the driver holds three numbers. A node of the tree draws from
a seed of its own (mix and range of shards), so subtrees are drawn on executors, FAN nodes a task and round. Orders
over many blocks are cut by a hash into groups of about GROUP, whose sums are added up first, so no window holds a whole source.

Defined results
---------------
* documents without a source, or of a source no target names, take no part (but count as corpus);
* null and empty texts have 0 tokens and go along with their block;
* a source without documents has quota 0; a mix without any tokens has no rows but is reported;
* a repeated row is a document of its own; targets with null share, cap or ratio count as 0, and those without mix or source are none;
* several targets of one source in one mix are one: their shares add up, the largest cap and ratio hold;
* the same seed gives the same mix whatever the partitioning; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadmill.llm.bpe import VOCABULARY, count_tokens
from leadmill.session import materialize

SHARD_TOKENS = 1_000_000
#: A block is that part of a shard; of more than MAX_UNITS blocks in all they are larger, as the drawing of counts needs.
BLOCK_PART, MAX_UNITS = 1 / 64, 500_000_000
#: Rows of a group whose order one window makes.
GROUP = 20_000
#: Nodes of the splitting tree that one task hands on in one round.
FAN = 1024
#: Up to that many sources are sent to all tasks; more are joined by a shuffle.
MAX_SENT = 10_000


def sized(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens): documents with their size."""
    slim = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").alias("text"))
    return count_tokens(slim, ["doc_id", "source"], "text", vocabulary)


def planned(targets: DataFrame, tokens: DataFrame, corpus: int, shard_tokens: int) -> DataFrame:
    """One row for each source of each mix: its quota, whole copies, rest and blocks, and the shards of the mix.

    ``tokens`` has (source, source_tokens).
    """
    number = lambda c, kind: F.coalesce(F.col(c).cast(kind), F.lit(0))
    wanted = targets.where("mix is not null and source is not null").groupBy(F.col("mix").cast("string").alias("mix"), F.col("source").cast("string").alias("source")).agg(
        F.sum(number("target_share", "double")).alias("target_share"), F.greatest(F.max(number("max_repeats", "int")), F.lit(0)).alias("max_repeats"),
        F.max(number("budget_ratio", "double")).alias("budget_ratio"),
    )
    size = F.col("source_tokens")
    plan = wanted.join(tokens, "source", "left").withColumn("source_tokens", F.coalesce(size, F.lit(0)))
    plan = plan.withColumn("budget_tokens", F.col("budget_ratio") * corpus)
    plan = plan.withColumn("quota_tokens", F.least(F.col("target_share") * F.col("budget_tokens"), (F.col("max_repeats") * size).cast("double")))
    plan = plan.withColumn("full", F.when(size > 0, F.least(F.col("max_repeats"), F.floor(F.col("quota_tokens") / size))).otherwise(0).cast("int"))
    plan = plan.withColumn("rest", F.when((size > 0) & (F.col("full") < F.col("max_repeats")), F.col("quota_tokens") - F.col("full") * size).otherwise(0.0))
    shards = plan.groupBy("mix").agg(F.greatest(F.lit(1), F.ceil(F.sum("quota_tokens") / shard_tokens)).cast("bigint").alias("shards"))
    return plan.join(shards, "mix")


def split_node(mix: str, low: int, high: int, held: np.ndarray, seed: int) -> np.ndarray:
    """The counts of the left half of a node's shards, drawn with the node's own seed."""
    total = int(held.sum())
    if not total:
        return held
    middle = (low + high) // 2
    rng = np.random.default_rng([seed, xxhash.xxh64_intdigest(mix), low, high])
    return rng.multivariate_hypergeometric(held, round(total * (middle - low) / (high - low)), method="marginals")


def grow(mix: str, low: int, high: int, held: np.ndarray, start: np.ndarray, seed: int, most: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """The nodes (low, high, counts, first places) under a node, level by level until there are ``most`` or all are single shards."""
    nodes = [(low, high, held, start)]
    while len(nodes) * 2 <= most and any(h - l > 1 for l, h, _, _ in nodes):
        below = []
        for l, h, n, s in nodes:  # noqa: E741
            if h - l == 1:
                below.append((l, h, n, s))
                continue
            left, middle = split_node(mix, l, h, n, seed), (l + h) // 2
            below += [(l, middle, left, s), (middle, h, n - left, s + left)]
        nodes = below
    return nodes


def split(counts: np.ndarray, shards: int, seed: int = 0, mix: str = "") -> np.ndarray:
    """Counts of each source for each shard: the whole tree. They add up to ``counts`` exactly, and
    shards' sizes differ by one block at most per level."""
    counts = np.asarray(counts, np.int64)
    nodes = grow(mix, 0, shards, counts, np.zeros_like(counts), seed, 4 * shards)
    return np.array([n for _, _, n, _ in sorted(nodes, key=lambda x: x[0])])


NODE = "mix string, low bigint, high bigint, sources array<string>, held array<bigint>, start array<bigint>"


def _next_level(nodes: DataFrame, seed: int) -> DataFrame:
    """Each node replaced by up to FAN nodes under it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = grow(r["mix"], r["low"], r["high"], np.array(r["held"], np.int64), np.array(r["start"], np.int64), seed, FAN)
                rows = [{"mix": r["mix"], "low": l, "high": h, "sources": r["sources"], "held": n.tolist(), "start": s.tolist()} for l, h, n, s in found]
                yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return nodes.repartition("mix", "low").mapInArrow(run, NODE)


def _ranked(units: DataFrame, key: list[str], place: Column, ties: list[str], size: str) -> DataFrame:
    """Rows with ``rank`` from 0 in an order by ``place`` within each key; ``size`` is the column with the number of its rows."""
    groups = F.ceil(F.col(size) / GROUP)
    placed = units.withColumn("place", place).withColumn("group", F.pmod(F.shiftrightunsigned("place", 20), groups))
    before = Window.partitionBy(*key).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*key, "group").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy(*key, "group").orderBy("place", *ties)
    return placed.withColumn("k", F.row_number().over(within)).join(sums.drop("n"), [*key, "group"]).withColumn("rank", F.col("before") + F.col("k") - 1).drop("k", "before", "group", "place")


def _partial(plan: DataFrame, blocks: DataFrame, seed: int) -> DataFrame:
    """(mix, source, copy, block, want) of the blocks of partial copies; ``want`` is null for a block taken whole, else what is wanted of it."""
    key = ["mix", "source"]
    held = plan.where("rest > 0").select(*key, F.col("full").alias("copy"), "rest", "n_blocks").join(blocks, "source")
    held = held.withColumn("place", F.xxhash64(F.lit(seed), F.lit(1), *key, "block"))
    held = held.withColumn("group", F.pmod(F.shiftrightunsigned("place", 20), F.ceil(F.col("n_blocks") / GROUP)))
    before = Window.partitionBy(*key).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = held.groupBy(*key, "group").agg(F.sum("tokens").alias("t")).withColumn("before", F.coalesce(F.sum("t").over(before), F.lit(0))).drop("t")
    so_far = Window.partitionBy(*key, "group").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = held.withColumn("sum", F.sum("tokens").over(so_far)).join(sums, [*key, "group"]).withColumn("sum", F.col("sum") + F.col("before"))
    at_cut = (F.col("sum") > F.col("rest")) & (F.col("sum") - F.col("tokens") < F.col("rest"))
    want = F.when(at_cut, F.col("rest") - F.col("sum") + F.col("tokens"))
    return summed.where((F.col("sum") <= F.col("rest")) | at_cut).select(*key, "copy", "block", want.alias("want"))


def mix(df: DataFrame, targets: DataFrame, seed: int = 7, shard_tokens: int = SHARD_TOKENS, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The mix (mix, shard, pos, source, doc_id, copy, n_tokens) and the report of shares."""
    key = ["mix", "source"]
    docs = materialize(sized(df, vocabulary), "sized-documents")
    tokens = docs.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"))
    corpus = int(tokens.agg(F.sum("source_tokens")).first()[0] or 0)
    plan = planned(targets, tokens.where("source is not null"), corpus, shard_tokens)
    most = plan.agg(F.sum(F.col("source_tokens") * (F.col("full") + 1))).first()[0] or 0
    block_tokens = max(1, int(shard_tokens * BLOCK_PART), int(most // MAX_UNITS))
    plan = materialize(plan.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_tokens") / block_tokens))), "mix-plan")

    named = plan.select("source", "n_blocks").distinct()
    if named.limit(MAX_SENT + 1).count() <= MAX_SENT:
        named = F.broadcast(named)
    placed = docs.join(named, "source").withColumn("block", F.pmod(F.xxhash64(F.lit(seed), F.lit(0), "doc_id"), "n_blocks")).drop("n_blocks")
    blocks = materialize(placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "blocks")

    partial = materialize(_partial(plan, blocks, seed), "partial-copies")
    whole = plan.where("full > 0").select(*key, F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("copy")).join(blocks.select("source", "block"), "source")
    units = whole.withColumn("want", F.lit(None).cast("double")).unionByName(partial)
    sizes = materialize(units.groupBy(*key).agg(F.count("*").alias("units")), "units-by-source")

    # shards: the counts by the tree, the blocks by runs of a permutation
    held = F.array_sort(F.collect_list(F.struct("source", "units")))
    nodes = sizes.groupBy("mix").agg(held.alias("x")).join(plan.select("mix", "shards").distinct(), "mix").select(
        "mix", F.lit(0).cast("bigint").alias("low"), F.col("shards").alias("high"), F.col("x.source").alias("sources"), F.col("x.units").alias("held"),
        F.transform("x", lambda _: F.lit(0).cast("bigint")).alias("start"),
    )
    width = int(plan.agg(F.max("shards")).first()[0] or 1)
    while True:
        nodes = _next_level(nodes, seed)
        width = -(-width // FAN)
        if width <= 1:
            break
    runs = nodes.select("mix", F.col("low").alias("shard"), F.explode(F.arrays_zip("sources", "held", "start")).alias("x")).where("x.held > 0")
    runs = runs.select("mix", F.col("x.sources").alias("source"), "shard", F.explode(F.sequence(F.col("x.start"), F.col("x.start") + F.col("x.held") - 1)).alias("rank"))
    ranked = _ranked(units.join(sizes, key), key, F.xxhash64(F.lit(seed), F.lit(2), *key, "copy", "block"), ["copy", "block"], "units")
    where = materialize(ranked.join(runs, [*key, "rank"]).select(*key, "copy", "block", "want", F.col("shard").cast("int").alias("shard")), "placed-blocks")

    met = placed.join(where, ["source", "block"])
    columns = ["mix", "shard", "source", "doc_id", "copy", "n_tokens"]
    so_far = Window.partitionBy(*key).orderBy(F.xxhash64(F.lit(seed), F.lit(4), "doc_id"), "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_cut = met.where("want is not null").withColumn("sum", F.sum("n_tokens").over(so_far)).where(F.col("sum") - F.col("n_tokens") / 2 <= F.col("want"))
    rows = met.where("want is null").select(columns).unionByName(at_cut.select(columns))
    order = F.xxhash64(F.lit(seed), F.lit(3), "mix", "doc_id", "copy")
    local = Window.partitionBy("mix", "shard").orderBy(order, "doc_id", "copy", "n_tokens")
    mixed = rows.withColumn("pos", F.row_number().over(local)).select("mix", "shard", "pos", "source", "doc_id", "copy", "n_tokens")
    return mixed, _report(plan, rows)


def _report(plan: DataFrame, rows: DataFrame) -> DataFrame:
    reached = rows.groupBy("mix", "source").agg(
        F.sum("n_tokens").alias("mixed_tokens"), F.count("*").alias("mixed_docs"), (F.max("copy") + 1).alias("most_repeats")
    )
    size = Window.partitionBy("mix")
    return (
        plan.select("mix", "source", "target_share", "max_repeats", "source_tokens", "budget_tokens", "quota_tokens")
        .join(reached, ["mix", "source"], "left")
        .na.fill(0, ["mixed_tokens", "mixed_docs", "most_repeats"])
        .withColumn("share_of_budget", F.round(F.try_divide("mixed_tokens", "budget_tokens"), 6))
        .withColumn("share_of_mix", F.round(F.try_divide("mixed_tokens", F.sum("mixed_tokens").over(size)), 6))
        .withColumn("met", F.col("quota_tokens") >= F.col("target_share") * F.col("budget_tokens"))
    )
