"""Sinks: appends, atomic rewrites, single files of several formats, snapshots and summaries.

Distributed tables are written by Spark's commit protocol. A single file (for people, or for a
program that wants one) is streamed partition by partition through the driver, never collected.
"""

from __future__ import annotations

import csv
import json
import os
import shutil
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.functions.text import or_not_available
from leadmill.schemas import LISTING_COLUMNS
from leadmill.sources import xlsx


def append_listings(df: DataFrame, path: str) -> None:
    """Append rows in the fixed columns: blanks become the sentinel, others are ignored."""
    have = set(df.columns)
    fixed = [
        (F.col(f"`{c}`") if c in have else F.lit(None)).cast("double").alias(c) if c == "Time Taken (sec)"
        else (or_not_available(F.col(f"`{c}`").cast("string")) if c in have else F.lit("Not available")).alias(c)
        for c in LISTING_COLUMNS
    ]
    df.select(*fixed).write.mode("append").parquet(path)


def append_progress(df: DataFrame, path: str) -> None:
    df.select("keyword", "href").write.mode("append").parquet(path)


def _paths(spark: SparkSession, path: str):
    """The Hadoop file system of a table, and the paths of its present, next and last version."""
    of = spark._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark._jsc.hadoopConfiguration()), *(of(path.rstrip("/") + tail) for tail in ("", ".next", ".last"))


def recover_table(spark: SparkSession, path: str) -> None:
    """Put a table right that a crash left between two versions: a complete next version takes its place, else the last one does."""
    fs, now, following, last = _paths(spark, path)
    if fs.exists(now):
        return
    for version in (following, last):
        done = spark._jvm.org.apache.hadoop.fs.Path(version, "_SUCCESS")
        if fs.exists(version) and (version is last or fs.exists(done)):
            fs.rename(version, now)
            return


def replace_table(df: DataFrame, path: str) -> None:
    """Rewrite a parquet folder of any Hadoop file system: the new version is complete before the old one goes, also if ``df`` reads the old one.

    Between the two renames the table has no present version; recover_table() mends a crash there.
    """
    spark = df.sparkSession
    fs, now, following, last = _paths(spark, path)
    df.write.mode("overwrite").parquet(str(following.toString()))
    fs.delete(last, True)
    if fs.exists(now) and not fs.rename(now, last):
        raise OSError(f"cannot move {path}")
    if not fs.rename(following, now):
        raise OSError(f"cannot replace {path}")
    fs.delete(last, True)


def _atomic(path: str, write: Callable[[str], None], retries: int = 5) -> None:
    """Write beside the target, flush to disk, then replace; a target held open is tried again."""
    staged = f"{path}.tmp"
    write(staged)
    with open(staged, "rb+") as f:
        os.fsync(f.fileno())
    for attempt in range(retries):
        try:
            os.replace(staged, path)
            return
        except PermissionError:
            if attempt == retries - 1:
                raise
            time.sleep(0.2 * (attempt + 1))


def write_file(df: DataFrame, path: str) -> int:
    """One csv, tsv, txt (with ``;``), json or xlsx file of all rows in their order; text files carry a byte-order mark."""
    ext = os.path.splitext(path)[1].lower()
    count = 0

    def delimited(separator: str) -> Callable[[str], None]:
        def write(staged: str) -> None:
            nonlocal count
            with open(staged, "w", newline="", encoding="utf-8-sig") as f:
                out = csv.writer(f, delimiter=separator)
                out.writerow(df.columns)
                for row in df.toLocalIterator(prefetchPartitions=True):
                    out.writerow(["" if v is None else v for v in row])
                    count += 1

        return write

    def records(staged: str) -> None:
        nonlocal count
        with open(staged, "w", encoding="utf-8") as f:
            f.write("[")
            for row in df.toLocalIterator(prefetchPartitions=True):
                f.write((",\n" if count else "\n") + json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str))
                count += 1
            f.write("\n]\n")

    def book(staged: str) -> None:
        nonlocal count
        count = xlsx.write_rows(staged, df.columns, map(tuple, df.toLocalIterator(prefetchPartitions=True)))

    writers = {".csv": delimited(","), ".tsv": delimited("\t"), ".txt": delimited(";"), ".json": records, ".xlsx": book}
    if ext not in writers:
        raise ValueError(f"unsupported format {ext or '(none)'}")
    _atomic(path, writers[ext])
    return count


def write_json_records(df: DataFrame, path: str, column: str = "record") -> int:
    """A JSON list of a column that holds one JSON text for each row."""
    count = 0

    def write(staged: str) -> None:
        nonlocal count
        with open(staged, "w", encoding="utf-8") as f:
            f.write("[")
            for row in df.select(column).toLocalIterator(prefetchPartitions=True):
                f.write((",\n" if count else "\n") + row[0])
                count += 1
            f.write("\n]\n")

    _atomic(path, write)
    return count


def write_clean_urls(clean: DataFrame, folder: str) -> tuple[int, int]:
    """The one-column list and the detail table."""
    os.makedirs(folder, exist_ok=True)
    return write_file(clean.select("website"), f"{folder}/clean_urls.csv"), write_file(clean, f"{folder}/clean_urls_detail.csv")


def try_write(df: DataFrame, path: str) -> str | None:
    """write_file that gives the error's text instead of raising it."""
    try:
        write_file(df, path)
        return None
    except Exception as e:  # noqa: BLE001
        return str(e).split("\n")[0]


def checked_name(path: str) -> str:
    stem, ext = os.path.splitext(path)
    return f"{stem}_WEBSITE_CHECKED{ext}"


def output_folder(input_path: str, internal: str, name: str = "EMAIL_DATA") -> str:
    """Inputs of the internal folder keep their place; others get a folder beside their own."""
    folder = os.path.dirname(os.path.abspath(input_path))
    if os.path.normcase(folder) == os.path.normcase(os.path.abspath(internal)):
        return internal
    return os.path.join(os.path.dirname(folder), name)


def snapshot(df: DataFrame, folder: str, now: str) -> str:
    """A dated copy of a table; ``now`` like 20260101_120000."""
    path = os.path.join(folder, f"backup_{now}")
    df.write.parquet(path)
    return path


def rotate(folder: str, keep: int = 5, prefix: str = "backup_") -> list[str]:
    """Remove all but the newest snapshots by name; gives what went."""
    names = sorted((n for n in os.listdir(folder) if n.startswith(prefix)), reverse=True) if os.path.isdir(folder) else []
    for n in names[keep:]:
        target = os.path.join(folder, n)
        shutil.rmtree(target) if os.path.isdir(target) else os.remove(target)
    return names[keep:]


def archive(paths: list[str], folder: str, now: str) -> list[str]:
    """Move state files that exist to a folder under dated names."""
    os.makedirs(folder, exist_ok=True)
    moved = []
    for p in paths:
        if os.path.exists(p):
            stem, ext = os.path.splitext(os.path.basename(p))
            to = os.path.join(folder, f"{stem}_{now}{ext}")
            shutil.move(p, to)
            moved.append(to)
    return moved


def _clock(seconds: float) -> str:
    h, rest = divmod(int(round(seconds)), 3600)
    return f"{h}h {rest // 60}m {rest % 60}s"


def append_summary(path: str, total: int, checked: int, seconds: float, now: str) -> str:
    """A dated block with counts, time and rates, appended to a text file."""
    rate = checked / seconds if seconds > 0 and checked > 0 else 0.0
    block = (
        f"finished: {now}\nrecords: {total}\nchecked: {checked}\ntime: {_clock(seconds)}\n"
        f"rate: {rate * 60:.1f} sites/minute, {rate * 3600:.0f} sites/hour\n\n"
    )
    with open(path, "a", encoding="utf-8") as f:
        f.write(block)
    return block


class SnapshotGate:
    """Opens once enough rows came and enough time went by since it last opened."""

    def __init__(self, rows: int = 200, seconds: float = 60, clock: Callable[[], float] = time.monotonic) -> None:
        self.rows, self.seconds, self.clock = rows, seconds, clock
        self.seen, self.last = 0, clock()

    def add(self, n: int) -> bool:
        self.seen += n
        if self.seen >= self.rows and self.clock() - self.last >= self.seconds:
            self.seen, self.last = 0, self.clock()
            return True
        return False
