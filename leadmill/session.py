"""Session helpers: a tuned local session, table loading, shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, name: str = "leadmill") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, with a part of its own for this application.

    ``spark.checkpoint.dir`` of the session is used. Only where it is unset and all executors are threads of
    this process (as in tests) a temporary folder is made and set; on a cluster a machine's own folder would lose
    what other machines write, so an unset folder is an error there. What is written is deleted when the driver ends.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        current = spark.sparkContext.getCheckpointDir()
        where = current.rsplit("/", 1)[0] if current else None
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="leadmill-")
        spark.conf.set("spark.checkpoint.dir", where)
    own = f"{where.rstrip('/')}/leadmill-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return own


def release(spark: SparkSession) -> None:
    """Delete what this application has materialized; DataFrames that read it can't be used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: the lineage is cut,
    later uses read the files, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan with a partition for each core at least: costly row work on a few small files would else
    leave cores idle. A scan of enough partitions, as any large table's, is not touched."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def data_dir(sf: str) -> str:
    return os.path.join(os.environ.get("TESTDATA_DIR", "/root/testdata"), sf)
