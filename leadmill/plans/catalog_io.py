"""Round trips through sinks and sources: what is written and read again must be the table it came from."""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill import schemas
from leadmill.functions.text import excel_safe
from leadmill.operators import exports, state
from leadmill.session import shared_folder, table
from leadmill.sinks import writers
from leadmill.sources import readers, sqlite
from leadmill.streaming import resume

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def new_folder(spark: SparkSession) -> str:
    """A new part of the shared folder, for sinks that write single files: it must be a mounted one."""
    where = shared_folder(spark)
    if "://" in where and not where.startswith("file://"):
        raise ValueError("single files are written to a mounted folder")
    path = os.path.join(where.removeprefix("file://"), f"io-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


def _checked(spark, sf_dir):
    c = table(spark, sf_dir, "status_checked")
    return c.select(F.col("lead_id").cast("string").alias("lead_id"), "Title", "Website", F.col("Mobile Number").alias("phone"), F.col("Status Code").alias("code"), F.col("Available").alias("available")).orderBy(F.col("lead_id").cast("bigint"))


def _checked_sql(empty: str = "nullif({0}, '')") -> str:
    columns = {"Title": '"Title"', "Website": '"Website"', "phone": '"Mobile Number"', "code": '"Status Code"', "available": '"Available"'}
    return "SELECT CAST(lead_id AS VARCHAR) AS lead_id, " + ", ".join(f"{empty.format(c)} AS {n}" for n, c in columns.items()) + " FROM status_checked"


def _round_trip(ext: str, read: Callable[[SparkSession, str], DataFrame]) -> Query:
    def run(spark, sf_dir):
        path = os.path.join(new_folder(spark), f"table{ext}")
        writers.write_file(_checked(spark, sf_dir), path)
        return read(spark, path)

    return run


for _ext, _read in (
    (".csv", readers.table), (".tsv", readers.table), (".txt", lambda spark, path: readers.csv(spark, path, ";")),
):
    QUERIES[f"io_{_ext[1:]}"] = _round_trip(_ext, _read)
    SQL[f"io_{_ext[1:]}"] = _checked_sql()
# these formats tell an empty text from none
for _ext in (".json", ".xlsx"):
    QUERIES[f"io_{_ext[1:]}"] = _round_trip(_ext, readers.table)
    SQL[f"io_{_ext[1:]}"] = _checked_sql("{0}")


def _lines(path: str, rows: list[str]) -> str:
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\n".join(rows) + "\n")
    return path


_KEYWORDS = "SELECT DISTINCT \"Search Term\" AS keyword FROM final_output WHERE \"Search Term\" IS NOT NULL AND trim(\"Search Term\") <> ''"


def _keywords(spark, sf_dir):
    return table(spark, sf_dir, "final_output").select(F.col("Search Term").alias("keyword")).where("trim(keyword) <> ''").distinct().orderBy("keyword")


@query(f"SELECT keyword FROM ({_KEYWORDS})")
def keywords_txt(spark, sf_dir):
    path = os.path.join(new_folder(spark), "keywords.txt")
    writers.write_file(_keywords(spark, sf_dir).withColumnRenamed("keyword", "Search Term"), path)
    return readers.keywords(spark, path)


@query(f"SELECT keyword FROM ({_KEYWORDS})")
def keywords_csv(spark, sf_dir):
    path = os.path.join(new_folder(spark), "keywords.csv")
    writers.write_file(_keywords(spark, sf_dir).select(F.lit("x").alias("notes"), F.col("keyword").alias("Query")), path)
    return readers.keywords(spark, path)


@query(f"SELECT keyword FROM ({_KEYWORDS})")
def keywords_workbook(spark, sf_dir):
    """The header stands below two other rows."""
    path = os.path.join(new_folder(spark), "keywords.xlsx")
    rows = _keywords(spark, sf_dir).select(F.lit(None).cast("string").alias("notes"), F.col("keyword").alias("list"))
    head = spark.createDataFrame([("made for", "tests"), ("n", "Search Keyword")], "notes string, list string")
    writers.write_file(head.coalesce(1).unionAll(rows.coalesce(1)), path)
    return readers.keywords(spark, path)


@query("SELECT url FROM websites")
def url_list_file(spark, sf_dir):
    """A line for each site, with text before the address; header and blank lines fall away."""
    path = os.path.join(new_folder(spark), "urls.txt")
    urls = [r.url for r in table(spark, sf_dir, "websites").select("url").toLocalIterator()]
    _lines(path, ["Website", "", *[f"site, {u.strip()}" if "," not in u else u for u in urls]])
    return readers.url_list(spark, path)


SQL["url_list_file"] = "SELECT regexp_replace(url, '^[\\s]+|[\\s]+$', '', 'g') AS url FROM websites"


@query(r"""SELECT coalesce(regexp_replace("Website", '^[\s\pZ]+|[\s\pZ]+$', '', 'g'), '') AS website, nullif("Available", '') AS available, f AS source_file, k AS file_ord
    FROM status_checked, (VALUES ('a.csv', 0), ('c.csv', 2)) t(f, k) WHERE lead_id % 2 = k / 2""")
def status_files_read(spark, sf_dir):
    """Two files with the columns, one without: it is skipped."""
    folder = new_folder(spark)
    rows = table(spark, sf_dir, "status_checked")
    for name, rest in (("a.csv", 0), ("c.csv", 1)):
        writers.write_file(rows.where(F.col("lead_id") % 2 == rest).select(F.col("Website").alias("Website "), F.col("Available").alias("AVAILABLE")), os.path.join(folder, name))
    _lines(os.path.join(folder, "b.csv"), ["x,y", "1,2"])
    df, skipped = readers.status_files(spark, [os.path.join(folder, f"{n}.csv") for n in "abc"])
    assert [os.path.basename(s) for s in skipped] == ["b.csv"]
    return df.select("website", "available", "source_file", "file_ord")


@query("SELECT lead_id, CAST(lead_id AS VARCHAR) || 'x' AS v FROM final_output WHERE lead_id % 7 <> 0")
def tolerant_csv_rows(spark, sf_dir):
    """Every seventh row has a number that is none; the file is kept aside and the good rows come back."""
    folder = new_folder(spark)
    path = os.path.join(folder, "state.csv")
    k = F.col("lead_id")
    rows = table(spark, sf_dir, "final_output").select(F.when(k % 7 == 0, F.concat(F.lit("bad"), k)).otherwise(k.cast("string")).alias("lead_id"), F.concat(k.cast("string"), F.lit("x")).alias("v"))
    writers.write_file(rows, path)
    good = readers.csv_or_quarantine(spark, path, "lead_id bigint, v string", os.path.join(folder, "bad"), "20260101_000000")
    assert os.listdir(os.path.join(folder, "bad")) == ["state_20260101_000000.csv"] and os.path.exists(path)
    return good


@query("SELECT \"Search Term\" AS keyword, arg_max(coalesce(nullif(\"Status\", ''), 'none'), lead_id) AS status FROM final_output WHERE trim(\"Search Term\") <> '' GROUP BY 1")
def keyword_status_last(spark, sf_dir):
    """Of repeated keywords the last row of the file counts."""
    path = os.path.join(new_folder(spark), "status.csv")
    rows = table(spark, sf_dir, "final_output").where("trim(`Search Term`) <> ''").orderBy("lead_id")
    writers.write_file(rows.select(F.col("Search Term").alias("keyword"), F.when(F.col("Status") == "", "none").otherwise(F.coalesce("Status", F.lit("none"))).alias("status")), path)
    return readers.keyword_status(spark, path)


@query("SELECT DISTINCT keyword, href FROM progress WHERE keyword <> '' AND href <> ''")
def progress_file(spark, sf_dir):
    path = os.path.join(new_folder(spark), "progress.csv")
    writers.write_file(table(spark, sf_dir, "progress").where("keyword <> '' and href <> ''").select("keyword", "href"), path)
    return readers.progress(spark, path)


@query(r"""SELECT CAST(lead_id AS VARCHAR) AS lead_id, coalesce(nullif(regexp_replace("Title", '^[\s\pZ]+|[\s\pZ]+$', '', 'g'), ''), 'Not available') AS title FROM final_output""")
def results_file(spark, sf_dir):
    path = os.path.join(new_folder(spark), "results.csv")
    writers.write_file(table(spark, sf_dir, "final_output").select("lead_id", F.col("Title").alias("title")), path)
    return readers.results(spark, path)


@query("SELECT id, url, status, domain_age_days FROM websites")
def sqlite_table(spark, sf_dir):
    path = os.path.join(new_folder(spark), "state.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE websites (id INTEGER PRIMARY KEY, url TEXT, status TEXT, domain_age_days INTEGER)")
        rows = table(spark, sf_dir, "websites").select("id", "url", "status", "domain_age_days").toLocalIterator()
        db.executemany("INSERT INTO websites VALUES (?, ?, ?, ?)", map(tuple, rows))
    db.close()
    return sqlite.read(spark, path, "websites").select(F.col("id").cast("bigint"), "url", "status", F.col("domain_age_days").cast("int"))


_TRIMMED = "regexp_replace({0}, '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g')"


@query("SELECT " + ", ".join(f'"{c}"' if c == "Time Taken (sec)" else f"coalesce(nullif({_TRIMMED.format(chr(34) + c + chr(34))}, ''), 'Not available') AS \"{c}\"" if c not in ("Email", "Rating") else f"'Not available' AS \"{c}\"" for c in schemas.LISTING_COLUMNS) + " FROM final_output, (VALUES (1), (2)) t(k)")
def append_listings_twice(spark, sf_dir):
    """Appended in the fixed columns: missing columns become the sentinel, others are ignored."""
    path = os.path.join(new_folder(spark), "listings")
    for _ in range(2):
        writers.append_listings(table(spark, sf_dir, "final_output").drop("Email", "Rating"), path)
    return spark.read.parquet(path)


@query("SELECT id, url, CASE WHEN id % 2 = 0 THEN 'completed' ELSE status END AS status FROM websites WHERE id % 5 <> 0")
def replaced_table(spark, sf_dir):
    """A table rewritten from itself, once after a crash between two versions."""
    path = os.path.join(new_folder(spark), "websites")
    table(spark, sf_dir, "websites").select("id", "url", "status").write.parquet(path)
    writers.replace_table(spark.read.parquet(path).where("id % 5 <> 0"), path)
    os.rename(path, f"{path}.last")
    writers.recover_table(spark, path)
    writers.replace_table(spark.read.parquet(path).withColumn("status", F.expr("CASE WHEN id % 2 = 0 THEN 'completed' ELSE status END")), path)
    return spark.read.parquet(path)


@query("SELECT id, url FROM websites, (VALUES (1), (2)) t(k)")
def snapshots_kept(spark, sf_dir):
    """Of three snapshots the two newest stay."""
    folder = new_folder(spark)
    for now in ("20260101_000000", "20260102_000000", "20260103_000000"):
        writers.snapshot(table(spark, sf_dir, "websites").select("id", "url"), folder, now)
    writers.rotate(folder, keep=2)
    return spark.read.parquet(*[os.path.join(folder, n) for n in sorted(os.listdir(folder))])


@query("SELECT id, url AS website, c AS phone FROM (SELECT w.id, w.url, regexp_replace(coalesce(r.phone, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') AS c FROM websites w LEFT JOIN extracted_results r ON w.id = r.website_id)")
def export_workbook(spark, sf_dir):
    """The wide export as a workbook, read again."""
    path = os.path.join(new_folder(spark), "export.xlsx")
    book = exports.workbook(table(spark, sf_dir, "websites"), table(spark, sf_dir, "extracted_results"))
    writers.write_file(book.select(F.col("id").cast("string").alias("id"), "website", excel_safe(F.col("phone")).alias("phone")), path)
    return readers.workbook(spark, path).select(F.col("id").cast("bigint"), "website", "phone")


@query("SELECT DISTINCT keyword, href FROM progress WHERE keyword IS NOT NULL AND href IS NOT NULL")
def stream_progress(spark, sf_dir):
    """The log of pairs as a stream, started twice from its checkpoint over a folder that grows, and once anew: no pair comes twice."""
    folder = new_folder(spark)
    rows = table(spark, sf_dir, "progress").where("keyword is not null and href is not null").select("keyword", "href")
    source, log = os.path.join(folder, "in"), os.path.join(folder, "log")
    rows.limit(0).write.parquet(log)
    for part in range(2):
        rows.where(F.pmod(F.hash("keyword"), F.lit(2)) == part).write.mode("append").parquet(source)
        resume.log_progress(spark, source, schemas.PROGRESS, log, os.path.join(folder, "ck")).awaitTermination()
    resume.log_progress(spark, source, schemas.PROGRESS, log, os.path.join(folder, "ck-new")).awaitTermination()
    return spark.read.parquet(log)


@query("SELECT w.id, coalesce(r.status, w.status) AS status FROM websites w LEFT JOIN (SELECT website_id, arg_max(coalesce(nullif(status, ''), 'none'), id) AS status FROM extracted_results GROUP BY 1) r ON r.website_id = w.id")
def stream_merge(spark, sf_dir):
    """Results merged into the queue as a stream, oldest file first; the same files merged again change nothing."""
    folder = new_folder(spark)
    queue, source = os.path.join(folder, "queue"), os.path.join(folder, "in")
    table(spark, sf_dir, "websites").select("id", "status").write.parquet(queue)
    last = table(spark, sf_dir, "extracted_results").select(F.col("website_id").alias("id"), F.when(F.col("status") == "", "none").otherwise(F.coalesce("status", F.lit("none"))).alias("status"), F.col("id").alias("at"))
    last.orderBy("at").coalesce(1).select("id", "status").write.parquet(source)
    for ck in ("ck", "ck-new"):
        resume.merge_results(spark, source, "id bigint, status string", queue, "id", os.path.join(folder, ck)).awaitTermination()
    return spark.read.parquet(queue)


@query("""SELECT w.id AS website_id, w.url, 'pending' AS status, '' AS email FROM (
    SELECT row_number() OVER (ORDER BY lead_id) AS id, url FROM (SELECT min(lead_id) AS lead_id, url FROM (
      SELECT lead_id, 'https://h' || (lead_id % 1000) || '.example' AS url FROM final_output) GROUP BY url)) w""")
def queue_load_results(spark, sf_dir):
    """New sites of a list get an empty result row each."""
    incoming = table(spark, sf_dir, "final_output").select("lead_id", F.concat(F.lit("https://h"), (F.col("lead_id") % 1000).cast("string"), F.lit(".example")).alias("url"))
    known = spark.createDataFrame([], schemas.WEBSITES)
    _, rows = state.load_queue(incoming, "url", "lead_id", known)
    return rows.select("website_id", "url", "status", "email")
