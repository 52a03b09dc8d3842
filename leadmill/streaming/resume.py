"""Resumable work as streams: new (keyword, href) pairs once each, and queue results merged by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadmill.operators import state
from leadmill.session import materialize
from leadmill.sinks.writers import SnapshotGate, recover_table, replace_table


def new_pairs(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs, once each, that the log does not have."""
    return pairs.select("keyword", "href").distinct().join(known.select("keyword", "href"), ["keyword", "href"], "left_anti")


def log_progress(spark: SparkSession, source: str, schema: str, log: str, checkpoint: str) -> StreamingQuery:
    """Append the new pairs of a parquet folder that grows to a log; restarts go on where they ended.

    Each batch is compared with the log as it is when the batch is written: a batch replayed after a crash finds
    its own pairs there and adds none, and no state is kept between batches.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, _: int) -> None:
        known = spark.read.schema("keyword string, href string").parquet(log)
        materialize(new_pairs(batch, known), "new-pairs").write.mode("append").parquet(log)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_rows(batch: DataFrame, key: str, file: str = "__file") -> DataFrame:
    """The last row of each key: of the newest file, and there the one furthest behind."""
    rows = batch.withColumn("__at", F.struct(file, F.monotonically_increasing_id()))
    columns = [c for c in batch.columns if c not in (key, file)]
    kept = rows.groupBy(key).agg(F.max_by(F.struct(*columns), "__at").alias("__row"))
    return kept.select(*[F.col(key) if c == key else F.col(f"__row.{c}").alias(c) for c in batch.columns if c != file])


def merge_results(
    spark: SparkSession, source: str, schema: str, table: str, key: str, checkpoint: str,
    on_snapshot: Callable[[DataFrame], None] | None = None, gate: SnapshotGate | None = None,
) -> StreamingQuery:
    """Merge batches of results into a table by key, the last row of a key in a batch; the same batch
    merged twice changes nothing. A table that a crash left between two versions is put right first. A gate tells
    when to hand out a snapshot."""
    recover_table(spark, table)
    base_schema = spark.read.parquet(table).schema

    def write(batch: DataFrame, _: int) -> None:
        recover_table(spark, table)
        current = spark.read.schema(base_schema).parquet(table)
        replace_table(state.merge(current, last_rows(batch, key), key), table)
        if on_snapshot is not None and gate is not None and gate.add(batch.count()):
            on_snapshot(spark.read.parquet(table))

    stream = spark.readStream.schema(schema).parquet(source)
    stream = stream.select("*", F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("__file"))
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
