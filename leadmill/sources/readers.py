"""Readers of keyword, lead, URL and state files. All columns are read as text: no inference."""

from __future__ import annotations

import os
import shutil
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.functions.text import nullif_pandas_na, or_not_available, py_strip
from leadmill.operators import columns
from leadmill.operators.dedupe import keep_first
from leadmill.session import materialize
from leadmill.sources import xlsx

FORMATS = [".xlsx", ".csv", ".tsv", ".txt", ".json"]


def checked_format(path: str) -> str:
    """The extension of an existing file of a known format."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    ext = os.path.splitext(path)[1].lower()
    if ext == ".xls":
        raise ValueError("the old binary workbook format .xls is not read; save the file as .xlsx")
    if ext not in FORMATS:
        raise ValueError(f"unsupported format {ext or '(none)'}; known: {', '.join(FORMATS)}")
    return ext


def csv(spark: SparkSession, path: str, sep: str = ",", pandas_na: bool = False, multi_line: bool = True) -> DataFrame:
    """All columns as text. With ``multi_line`` a quoted cell may hold line breaks, and a file is one task; without, large files are split."""
    df = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("sep", sep).option("quote", '"').csv(path)
    if pandas_na:
        df = df.select(*[nullif_pandas_na(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return df


def ordered(df: DataFrame, name: str = "_ord") -> DataFrame:
    """A row number by file order; ids follow it for a single file only, so add it before any union."""
    return df.withColumn(name, F.monotonically_increasing_id())


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def workbook(spark: SparkSession, path: str, sheet: str | None = None, header: int = 0) -> DataFrame:
    xlsx.register(spark)
    reader = spark.read.format("xlsx").option("path", path).option("headerRow", str(header))
    return (reader.option("sheet", sheet) if sheet else reader).load()


def keyword_workbook(spark: SparkSession, path: str, sheet: str | None = None, preferred: str = "Search Keyword") -> DataFrame:
    """The sheet asked for (exact name, then a part of it either way) if it has a header, else the
    first sheet with one, else the first sheet from its first row."""
    names = xlsx.sheet_names(path)
    known = [preferred.lower(), *columns.KEYWORD_NAMES]

    def header(s: str) -> int | None:
        top = [row for row, _ in zip(xlsx.read_rows(path, s), range(20))]
        return columns.header_row(top, known)

    chosen = None
    if sheet:
        want = sheet.strip().lower()
        chosen = next((s for s in names if s.strip().lower() == want), None) or next((s for s in names if want in s.strip().lower() or s.strip().lower() in want), None)
    row = header(chosen) if chosen else None
    if row is None:
        chosen, row = next(((s, h) for s in names if (h := header(s)) is not None), (names[0], 0))
    return workbook(spark, path, chosen, row)


def keywords(spark: SparkSession, path: str, preferred: str = "Search Keyword", sheet: str | None = None) -> DataFrame:
    """(keyword): one row for each entry, repeats kept, blanks dropped."""
    ext = checked_format(path)
    if ext == ".txt":
        named = [preferred.lower(), *columns.KEYWORD_NAMES]
        rows = ordered(lines(spark, path).select(py_strip(F.col("value")).alias("keyword")).where("keyword <> ''"))
        first = rows.agg(F.min("_ord")).scalar()
        return rows.where((F.col("_ord") != first) | ~F.lower("keyword").isin(named)).select("keyword")
    df = keyword_workbook(spark, path, sheet, preferred) if ext == ".xlsx" else csv(spark, path)
    name = columns.keyword_column(df.columns, preferred)
    return df.select(py_strip(F.col(f"`{name}`")).alias("keyword")).where("keyword <> ''")


def table(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Any known format. Text files take the first separator that gives several columns, else they are one column of lines."""
    ext = checked_format(path)
    if ext == ".xlsx":
        return workbook(spark, path, sheet)
    if ext == ".csv":
        return csv(spark, path)
    if ext == ".tsv":
        return csv(spark, path, "\t")
    if ext == ".json":
        return json_table(spark, path)
    for sep in ("\t", ";", ","):
        df = csv(spark, path, sep)
        if len(df.columns) > 1:
            return df
    return lines(spark, path).where("trim(value) <> ''").select(py_strip(F.col("value")).alias("Website"))


def json_table(spark: SparkSession, path: str) -> DataFrame:
    """A list of records, an object with such a list, or one record."""
    df = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    types = dict(df.dtypes)
    for c in ("records", "data", "results", "items"):
        if types.get(c, "").startswith("array<struct"):
            return df.select(F.inline(c))
    return df


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(url): for each line, the first comma part with a dot or http; header lines and blanks fall away."""
    line = py_strip(F.col("value"))
    parts = F.filter(F.transform(F.split(line, ","), py_strip), lambda p: F.contains(p, F.lit(".")) | p.startswith("http"))
    kept = lines(spark, path).where((line != "") & ~F.lower(line).startswith("website") & ~F.lower(line).startswith("url"))
    return kept.select(F.get(parts, F.lit(0)).alias("url")).where("url is not null")


def status_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, list[str]]:
    """Rows (website, available, source_file, file_ord, _ord) of the files in their order, and the files
    skipped: missing, or without the columns. Column names count without case and blanks; of equal ones the last."""
    found, skipped = [], []
    for k, path in enumerate(paths):
        if not os.path.exists(path):
            skipped.append(path)
            continue
        df = ordered(csv(spark, path))
        named = {c.strip().lower().lstrip("﻿"): c for c in df.columns}
        if "website" not in named or "available" not in named:
            skipped.append(path)
            continue
        found.append(
            df.select(
                py_strip(F.coalesce(F.col(f"`{named['website']}`"), F.lit(""))).alias("website"), F.col(f"`{named['available']}`").alias("available"),
                F.lit(os.path.basename(path)).alias("source_file"), F.lit(k).alias("file_ord"), "_ord",
            )
        )
    return (reduce(DataFrame.unionByName, found) if found else None), skipped


def csv_or_quarantine(spark: SparkSession, path: str, schema: str, bad_folder: str, now: str) -> DataFrame:
    """A state file that may be damaged, in three steps: as it should be; else its good rows, the original kept aside under a dated
    name; else, if no row is good, an empty table, the file moved aside."""
    try:
        good, bad = tolerant_csv(spark, path, schema)
        some, damaged = not good.isEmpty(), not bad.isEmpty()
    except Exception:  # noqa: BLE001
        some, damaged = False, True
    if not damaged:
        return good
    os.makedirs(bad_folder, exist_ok=True)
    stem, ext = os.path.splitext(os.path.basename(path))
    aside = os.path.join(bad_folder, f"{stem}_{now}{ext}")
    if some:
        shutil.copy2(path, aside)
        return good
    shutil.move(path, aside)
    return spark.createDataFrame([], schema)


def resumed(spark: SparkSession, own_output: str, status_column: str) -> DataFrame | None:
    """The own output of an earlier run to go on from, or None for a fresh start: no file, no row, or no such column."""
    if not os.path.exists(own_output):
        return None
    df = table(spark, own_output)
    return df if status_column in df.columns and not df.isEmpty() else None


def tolerant_csv(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the raw text of rows that do not fit the schema."""
    raw = (
        spark.read.schema(schema + ", _corrupt_record string").option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record").option("escape", '"').csv(path)
    )
    kept = materialize(raw, "tolerant-csv")  # the mark of bad rows cannot be asked for alone on a raw scan
    return kept.where("_corrupt_record is null").drop("_corrupt_record"), kept.where("_corrupt_record is not null").select("_corrupt_record")


def progress(spark: SparkSession, path: str) -> DataFrame:
    return csv(spark, path).select("keyword", "href").distinct()


def keyword_status(spark: SparkSession, path: str) -> DataFrame:
    """Of repeated keywords the last row counts."""
    return keep_first(ordered(csv(spark, path)), F.col("keyword"), F.col("_ord").desc()).select("keyword", "status")


def results(spark: SparkSession, path: str) -> DataFrame:
    """Stored listings with the sentinel for missing values."""
    df = csv(spark, path)
    return df.select(*[or_not_available(F.col(f"`{c}`")).alias(c) for c in df.columns])
