"""Duplicates hidden by formatting: collapse records that differ only in dress.

A record is reduced to a canonical key by built-in expressions (letter case, white space,
invisible characters, punctuation, a leading scheme or www., the order of several numbers
and the order of the two fields do not count). Then

1. every task sends the distinct key hashes of its batches, 9 bytes each, to the range of the key space they belong to; there
   they are merged into the range's two Bloom filters, of keys seen and of keys seen again. A range has about RANGE_ROWS
   rows, so its filters never saturate, however many keys there are, and no task sends whole filters;
2. each range owns its part of one "seen again" filter of bounded size, in which only keys that repeat set bits. It is
   sent to all tasks, and only rows it says may repeat are shuffled and grouped by their whole key;
3. all other rows are singletons.

The filter has no false negatives, so the result is exact at every size: more repeated keys than it is made for
only let more rows into the exact grouping.

Skew: groups are pre-aggregated before the shuffle. Groups that hold 1/256 of all rows or
more, of which there are at most 256, meet their rows by a broadcast join; no task gets a
whole hot group.

Defined results
---------------
* a record takes part only if both fields are given (not null, blank or ``Not available``
  in any case); all others are singletons of their own;
* a field of punctuation only is given, and its canonical form is empty;
* of tied rows the smallest id is first; a repeated row under one id counts as one more copy, and is no copy of itself in copies();
* texts of any length are read whole; an empty table gives an empty result;
* only the named columns are read; other columns and their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.session import materialize

PROBES = 4
#: Rows of one range of the key space, and the smallest part of the filter that a range owns.
RANGE_ROWS, BLOCK_BITS = 1 << 22, 1 << 16
#: Bits of filter for each row, and the bounds of its size: 8 KB to 32 MB.
BITS_PER_ROW, MIN_BITS, MAX_BITS = 12, 1 << 16, 1 << 28
HOT_PART = 256


def squeezed(c: Column) -> Column:
    """Lower case without white space, control and other invisible characters."""
    return F.regexp_replace(F.lower(c), r"[\s\p{Z}\p{C}]+", "")


def is_given(c: Column) -> Column:
    s = squeezed(c)
    return c.isNotNull() & (s != "") & (s != "notavailable")


def canonical_field(c: Column) -> Column:
    """Letters and digits of a web address, or the sorted set of numbers of a phone field."""
    s = squeezed(c)
    web = reduce(
        lambda x, p: F.regexp_replace(x, p, ""),
        [r"^[^\p{L}\p{N}]+", r"^https?:/*", r"^www\.", r"[^\p{L}\p{M}\p{N}]+"],
        s,
    )
    spaced = F.regexp_replace(F.regexp_replace(F.lower(c), r"\p{Cf}+", ""), r"[\s\p{Z}\p{Cc}]+", " ")
    numbers = F.split(spaced, r"[,;|]| /+ ")
    bare = F.transform(numbers, lambda x: F.regexp_replace(x, r"[^\p{L}\p{M}\p{N}]+", ""))
    phone = F.array_join(F.array_sort(F.array_distinct(F.filter(bare, lambda x: x != ""))), ",")
    return F.when(s.rlike(r"[\p{L}\p{N}]\.\p{L}{2,}"), web).otherwise(phone)


def canonical_key(a: Column, b: Column) -> Column:
    """One key for both orders of the fields."""
    x, y = canonical_field(a), canonical_field(b)
    return F.concat(F.least(x, y), F.lit("|"), F.greatest(x, y))


def filter_bits(rows: int) -> int:
    """A power of two with BITS_PER_ROW for each row, within the bounds."""
    want = max(MIN_BITS, min(MAX_BITS, BITS_PER_ROW * max(rows, 1)))
    return 1 << (want - 1).bit_length()


def probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The places of each hash in the filter, one array for each probe."""
    h = hashes.astype(np.int64).view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(j) * high) & np.uint64(bits - 1)).astype(np.int64) for j in range(PROBES)]


def has_bits(bitmap: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
    """Whether all places of a hash are set."""
    hit = np.ones(len(places[0]), dtype=bool)
    for p in places:
        hit &= (bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
    return hit


def set_bits(bitmap: np.ndarray, places: list[np.ndarray]) -> None:
    for p in places:
        np.bitwise_or.at(bitmap, p >> 3, np.left_shift(np.uint8(1), (p & 7).astype(np.uint8)))


def ranges_of(rows: int, bits: int) -> int:
    """A power of two: ranges of RANGE_ROWS rows at most, with a part of the filter each."""
    return min(1 << max(0, (max(rows, 1) - 1) // RANGE_ROWS).bit_length(), max(1, bits // BLOCK_BITS))


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each hash, by other bits than the probes use."""
    mixed = hashes.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) & np.uint64(ranges - 1)).astype(np.int32)


def filter_places(hashes: np.ndarray, bits: int, ranges: int) -> list[np.ndarray]:
    """The places of each hash in the filter: within the part of its range."""
    own = bits // ranges
    first = range_of(hashes, ranges).astype(np.int64) * own
    return [first + p for p in probes(hashes, own)]


def repeat_filter(hashes: DataFrame, bits: int, rows: int | None = None) -> np.ndarray:
    """The filter of keys that may repeat, over a DataFrame of one hash column of about so many rows."""
    ranges = ranges_of(rows if rows is not None else bits // BITS_PER_ROW, bits)
    own = bits // ranges
    local = max(own, filter_bits((rows if rows is not None else bits // BITS_PER_ROW) // ranges + 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unique, counts = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(range_of(unique, ranges)), pa.array(unique), pa.array(counts > 1)], names=["range", "hash", "again"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen, again = None, None, None

        def handed_out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([again.tobytes()], pa.binary())], names=["range", "again"])

        for batch in batches:
            ranges_here, hashes_here, repeated_here = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for r in np.unique(ranges_here):
                if r != at:
                    if at is not None and again.any():
                        yield handed_out()
                    at, seen, again = int(r), np.zeros(local // 8, np.uint8), np.zeros(own // 8, np.uint8)
                mine = ranges_here == r
                unique, where = np.unique(hashes_here[mine], return_inverse=True)
                repeated = np.bincount(where, minlength=len(unique)) > 1
                np.logical_or.at(repeated, where, repeated_here[mine])
                places = probes(unique, local)
                repeated |= has_bits(seen, places)
                set_bits(seen, places)
                set_bits(again, probes(unique[repeated], own))
        if at is not None and again.any():
            yield handed_out()

    sent = hashes.mapInArrow(send, "range int, hash bigint, again boolean").repartition("range").sortWithinPartitions("range")
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in sent.mapInArrow(merge, "range int, again binary").toLocalIterator():
        bitmap[row.range * own // 8 : (row.range + 1) * own // 8] = np.frombuffer(row.again, np.uint8)
    return bitmap


def keyed(df: DataFrame, id_col: str, field_a: str, field_b: str) -> DataFrame:
    """(id, key, hash) of the records with both fields given."""
    a, b = F.col(f"`{field_a}`").cast("string"), F.col(f"`{field_b}`").cast("string")
    return (
        df.where(is_given(a) & is_given(b))
        .select(F.col(f"`{id_col}`").cast("bigint").alias("id"), canonical_key(a, b).alias("key"))
        .withColumn("hash", F.xxhash64("key"))
    )


def split_by_filter(df: DataFrame, id_col: str, field_a: str, field_b: str, rows: int | None = None) -> DataFrame:
    """keyed() with ``may_repeat``: false is certain, true is to be checked exactly."""
    records = keyed(df, id_col, field_a, field_b)
    total = df.count() if rows is None else rows
    bits = filter_bits(total)
    ranges = ranges_of(total, bits)
    sent = df.sparkSession.sparkContext.broadcast(repeat_filter(records.select("hash"), bits, total))

    @F.pandas_udf("boolean")
    def may_repeat(h: pd.Series) -> pd.Series:
        return pd.Series(has_bits(sent.value, filter_places(h.to_numpy(), bits, ranges)))

    return records.withColumn("may_repeat", may_repeat("hash"))


def copies(df: DataFrame, id_col: str, field_a: str, field_b: str) -> DataFrame:
    """(first_id, copy_id): each copy of a record but the first."""
    total = df.count()
    rows = materialize(
        split_by_filter(df, id_col, field_a, field_b, total).where("may_repeat").select("id", "key"), "repeats"
    )
    groups = materialize(
        rows.groupBy("key").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).where("n > 1"), "groups"
    )
    hot = F.broadcast(groups.where(F.col("n") * HOT_PART >= total))
    cold = groups.where(F.col("n") * HOT_PART < total)
    met = rows.join(hot, "key").unionByName(rows.join(hot, "key", "left_anti").join(cold, "key"))
    return met.where("id <> first_id").select("first_id", F.col("id").alias("copy_id"))


def collapse(df: DataFrame, id_col: str, field_a: str, field_b: str) -> DataFrame:
    """(id, n_copies): one row for each record with both fields, its smallest id, and how many copies it had."""
    rows = split_by_filter(df, id_col, field_a, field_b)
    single = rows.where("not may_repeat").select("id", F.lit(1).cast("bigint").alias("n_copies"))
    grouped = rows.where("may_repeat").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n_copies"))
    return single.unionByName(grouped.select("id", "n_copies"))


def collapse_all(df: DataFrame, id_col: str, field_a: str, field_b: str) -> DataFrame:
    """(id, n_copies): collapse() and each record without both fields as a singleton of its own."""
    a, b = F.col(f"`{field_a}`").cast("string"), F.col(f"`{field_b}`").cast("string")
    alone = df.where(~(is_given(a) & is_given(b))).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("n_copies"))
    return collapse(df, id_col, field_a, field_b).unionByName(alone)
