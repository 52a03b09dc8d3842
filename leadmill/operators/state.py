"""Queue and result tables: conditional updates and merges of immutable tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadmill.functions import urls
from leadmill.functions.dates import legacy_age
from leadmill.functions.text import py_strip
from leadmill.operators.dedupe import keep_first
from leadmill.session import materialize

STATUSES = ["pending", "processing", "completed", "failed", "no_data"]


def queue_stats(websites: DataFrame) -> DataFrame:
    """One row with the number of sites by state; unknown states count in the total only."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    return websites.agg(*counts, F.count("*").alias("total"))


def new_urls(incoming: DataFrame, url: str, ord_col: str, websites: DataFrame) -> DataFrame:
    """(id, url, domain, status): URLs not in the queue yet, once each, with ids behind the largest one.

    Ids come from a global order of the new rows only; known URLs are never touched.
    """
    cleaned = incoming.select(urls.queue_url(F.col(url)).alias("url"), F.col(ord_col).alias("ord")).where(py_strip(F.col("url")) != "https://")
    fresh = keep_first(cleaned, F.col("url"), "ord").join(websites.select("url"), "url", "left_anti")
    numbered = _numbered(fresh, "ord")
    last = websites.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return numbered.select(
        (last + F.col("n")).alias("id"), "url", F.lower(urls.netloc(F.col("url"))).alias("domain"), F.lit("pending").alias("status")
    )


def _numbered(df: DataFrame, order: str) -> DataFrame:
    """Rows with ``n`` from 1 in an order: counts of range partitions first, then within each.

    The partition of each row is written down once; evaluated a second time, adaptive execution could cut the
    ranges in another way, and the counts would not fit the rows.
    """
    parted = materialize(df.repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id()), "numbered")
    sizes = parted.groupBy("__part").agg(F.count("*").alias("__size"))
    before = sizes.withColumn(
        "__before", F.coalesce(F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("__size")
    within = Window.partitionBy("__part").orderBy(order)
    return (
        parted.withColumn("__k", F.row_number().over(within))
        .join(before, "__part")
        .withColumn("n", F.col("__before") + F.col("__k"))
        .drop("__part", "__k", "__before")
    )


def numbered_within(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows with ``place`` from 1 within each key, in an order: range partitions, written down once, cut a hot key into
    several tasks; what stands before a partition is added to the places in it."""
    parted = materialize(df.repartitionByRange(F.col(key), *order).withColumn("__part", F.spark_partition_id()), "numbered")
    sizes = parted.groupBy(key, "__part").agg(F.count("*").alias("__size"))
    earlier = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col(key).alias("__key"), "__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
    placed = parted.withColumn("__k", F.row_number().over(Window.partitionBy("__part", key).orderBy(*order)))
    met = placed.join(before, (placed["__part"] == before["__part"]) & placed[key].eqNullSafe(before["__key"]))
    return met.select(*df.columns, (F.col("__before") + F.col("__k")).alias("place"))


def load_queue(incoming: DataFrame, url: str, ord_col: str, websites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The new sites of a URL list, and the empty result row of each."""
    fresh = materialize(new_urls(incoming, url, ord_col, websites), "new-sites")
    return fresh, pending_results(fresh)


def pending_results(fresh: DataFrame) -> DataFrame:
    """The empty result rows of new sites."""
    return fresh.select(F.col("id").alias("website_id"), "url", "status", *[F.lit("").alias(c) for c in ("email", "phone", "address")])


def claim(websites: DataFrame, n: int) -> DataFrame:
    """(id, url, domain) of the n pending sites with the smallest ids."""
    return websites.where("status = 'pending'").orderBy("id").limit(n).select("id", "url", "domain")


def claimed(websites: DataFrame, n: int) -> DataFrame:
    """The queue after the claim."""
    batch = F.broadcast(claim(websites, n).select("id", F.lit(True).alias("__claimed")))  # n rows at most
    status = F.when(F.col("__claimed"), "processing").otherwise(F.col("status"))
    return websites.join(batch, "id", "left").withColumn("status", status).drop("__claimed")


def reset_interrupted(websites: DataFrame) -> DataFrame:
    return websites.withColumn("status", F.when(F.col("status") == "processing", "pending").otherwise(F.col("status")))


def requeue(websites: DataFrame, statuses: list[str]) -> DataFrame:
    """The queue with sites of these states pending again and without their error."""
    again = F.col("status").isin(statuses)
    return websites.withColumns(
        {"status": F.when(again, "pending").otherwise(F.col("status")), "error_message": F.when(~F.coalesce(again, F.lit(False)), F.col("error_message"))}
    )


def requeue_results(results: DataFrame, websites: DataFrame, statuses: list[str]) -> DataFrame:
    """The results whose site is requeued pending too."""
    ids = websites.where(F.col("status").isin(statuses)).select(F.col("id").alias("website_id"), F.lit(True).alias("__again"))
    status = F.when(F.col("__again"), "pending").otherwise(F.col("status"))
    return results.join(ids, "website_id", "left").withColumn("status", status).drop("__again")


def merge(base: DataFrame, updates: DataFrame, *key: str) -> DataFrame:
    """The base with rows of the same key replaced by the updates and new ones added; of several
    columns, those an update lacks are null."""
    return base.join(updates.select(*key), list(key), "left_anti").unionByName(updates, allowMissingColumns=True)


def last_by(df: DataFrame, key: str, value: str, ord_col: str) -> DataFrame:
    """Of duplicate keys the last value counts."""
    return df.groupBy(key).agg(F.max_by(value, ord_col).alias(value))


def missing_keys(seen: DataFrame, known: DataFrame, *key: str) -> DataFrame:
    """Keys not known yet."""
    return seen.select(*key).distinct().join(known, list(key), "left_anti")


def migrate_age(df: DataFrame, days: str, text: str) -> DataFrame:
    """The day count from the old text where the new column is null; the old column goes."""
    return df.withColumn(days, F.coalesce(F.col(days), legacy_age(F.col(text)))).drop(text)


def add_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Columns that are absent, as nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})


def order_columns(df: DataFrame, known: list[str]) -> DataFrame:
    """Known columns first, others behind in their order."""
    return df.select(*[c for c in known if c in df.columns], *[c for c in df.columns if c not in known])


def has_any(*columns: Column) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | (F.coalesce(c, F.lit("")) != "")
    return out
