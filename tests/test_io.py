"""Readers, writers, workbooks, snapshots and streams on small files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from leadmill.sinks import writers
from leadmill.sources import readers, xlsx
from leadmill.streaming import resume


def put(folder, name, content, encoding="utf-8"):
    path = os.path.join(str(folder), name)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(content)
    return path


def test_keywords(spark, tmp_path):
    assert [r.keyword for r in readers.keywords(spark, put(tmp_path, "k.txt", "Keyword\n baker \n\nbaker\nplumber\n")).collect()] == ["baker", "baker", "plumber"]
    assert [r.keyword for r in readers.keywords(spark, put(tmp_path, "k.csv", "a,Query\n1,x\n2,\n3,y\n")).collect()] == ["x", "y"]
    path = os.path.join(tmp_path, "k.xlsx")
    xlsx.write_rows(path, ["notes", None], iter([("", "Search Term"), (1, "a"), (None, None), (2, " b ")]))
    assert [r.keyword for r in readers.keywords(spark, path).collect()] == ["a", "b"]


def test_universal_reader(spark, tmp_path):
    assert readers.table(spark, put(tmp_path, "a.txt", "x;y\n1;2\n")).columns == ["x", "y"]
    assert [r.Website for r in readers.table(spark, put(tmp_path, "b.txt", "Website\n a.com \n\n")).collect()] == ["Website", "a.com"]
    assert readers.table(spark, put(tmp_path, "c.tsv", "x\ty\n1\t2\n")).first().y == "2"
    assert readers.table(spark, put(tmp_path, "d.json", json.dumps({"data": [{"u": "a"}, {"u": "b"}]}))).count() == 2
    assert readers.table(spark, put(tmp_path, "e.json", json.dumps([{"u": 1}, {"u": 2}]))).count() == 2
    assert readers.table(spark, put(tmp_path, "f.json", json.dumps({"u": "a"}))).count() == 1
    with pytest.raises(ValueError):
        readers.table(spark, put(tmp_path, "g.doc", ""))
    with pytest.raises(FileNotFoundError):
        readers.table(spark, os.path.join(tmp_path, "none.csv"))


def test_csv_keeps_texts(spark, tmp_path):
    df = readers.csv(spark, put(tmp_path, "a.csv", 'p,q\n61412345678,"a ""b"", c\nd"\n,NA\n'), pandas_na=True)
    assert [tuple(r) for r in df.collect()] == [("61412345678", 'a "b", c\nd'), (None, None)]


def test_status_files(spark, tmp_path):
    a = put(tmp_path, "a.csv", "﻿Website ,AVAILABLE\nhttps://a.com,Yes\n,no\n")
    b = put(tmp_path, "b.csv", "x,y\n1,2\n")
    df, skipped = readers.status_files(spark, [a, b, os.path.join(tmp_path, "c.csv"), a])
    assert skipped == [b, os.path.join(tmp_path, "c.csv")]
    assert [(r.website, r.file_ord) for r in df.orderBy("file_ord", "_ord").collect()] == [("https://a.com", 0), ("", 0), ("https://a.com", 3), ("", 3)]


def test_url_list(spark, tmp_path):
    path = put(tmp_path, "u.csv", "website\nurlaub.de\nname, a.com, b.com\n\nnodot\nhttp://x\n")
    assert [r.url for r in readers.url_list(spark, path).collect()] == ["a.com", "http://x"]


def test_tolerant_csv_and_state(spark, tmp_path):
    good, bad = readers.tolerant_csv(spark, put(tmp_path, "t.csv", "a,b\n1,x\nzz,y\n2,z\n"), "a int, b string")
    assert [r.a for r in good.collect()] == [1, 2] and bad.count() == 1
    path = put(tmp_path, "s.csv", "keyword,status\nk,Not Completed\nk,Completed\n")
    assert [tuple(r) for r in readers.keyword_status(spark, path).collect()] == [("k", "Completed")]
    assert readers.results(spark, put(tmp_path, "r.csv", "a,b\n, x \n")).first().asDict() == {"a": "Not available", "b": "x"}
    assert readers.progress(spark, put(tmp_path, "p.csv", "keyword,href\nk,1\nk,1\n")).count() == 1


def test_workbook_round_trip(spark, tmp_path):
    path = os.path.join(tmp_path, "w.xlsx")
    df = spark.createDataFrame([("a<b>&", 1.5, None), ("é\x00x", 2.0, "z")], "t string, n double, u string")
    assert writers.write_file(df, path) == 2
    back = readers.workbook(spark, path)
    assert back.columns == ["t", "n", "u"] and sorted(tuple(r) for r in back.collect()) == [("a<b>&", "1.5", None), ("éx", "2.0", "z")]
    assert xlsx.sheet_names(path) == ["Sheet1"]


@pytest.mark.parametrize("ext", [".csv", ".tsv", ".txt", ".json"])
def test_files_round_trip(spark, tmp_path, ext):
    path = os.path.join(tmp_path, f"o{ext}")
    df = spark.createDataFrame([("a,b;c\td", "1"), ('q"', None)], "t string, n string")
    assert writers.write_file(df, path) == 2 and not os.path.exists(path + ".tmp")
    got = readers.table(spark, path) if ext != ".txt" else readers.csv(spark, path, ";")
    assert sorted((r.t, r.n) for r in got.collect()) == [("a,b;c\td", "1"), ('q"', None)]
    with pytest.raises(ValueError):
        writers.write_file(df, os.path.join(tmp_path, "o.doc"))
    assert writers.try_write(df, os.path.join(tmp_path, "o.doc")).startswith("unsupported")


def test_tables_and_snapshots(spark, tmp_path):
    path = os.path.join(tmp_path, "t")
    spark.range(3).write.parquet(path)
    writers.replace_table(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    for k in range(4):
        writers.snapshot(spark.range(1), os.path.join(tmp_path, "b"), f"2026010{k}_000000")
    assert writers.rotate(os.path.join(tmp_path, "b"), keep=2) == ["backup_20260101_000000", "backup_20260100_000000"]
    f = put(tmp_path, "s.csv", "x")
    assert len(writers.archive([f, f + "no"], os.path.join(tmp_path, "ar"), "n")) == 1 and not os.path.exists(f)
    listing = spark.createDataFrame([(" x ", "extra")], "Title string, Other string")
    writers.append_listings(listing, os.path.join(tmp_path, "l"))
    writers.append_listings(listing, os.path.join(tmp_path, "l"))
    rows = spark.read.parquet(os.path.join(tmp_path, "l")).collect()
    assert len(rows) == 2 and rows[0].Title == "x" and rows[0].Website == "Not available"
    writers.append_progress(spark.createDataFrame([("k", "h")], "keyword string, href string"), os.path.join(tmp_path, "pr"))


def test_names_and_summaries(tmp_path):
    assert writers.checked_name("/a/b.csv") == "/a/b_WEBSITE_CHECKED.csv"
    assert writers.output_folder("/x/y/z/in.csv", "/x/in", "OUT") == "/x/y/OUT" and writers.output_folder("/x/in/a.csv", "/x/in") == "/x/in"
    assert "time: 1h 0m 5s" in writers.append_summary(os.path.join(tmp_path, "d.txt"), 9, 3, 3605, "now")
    assert "30.0 sites/minute" in writers.append_summary(os.path.join(tmp_path, "s.txt"), 9, 3, 6, "now")
    clock = iter([0, 10, 70, 70, 80]).__next__
    gate = writers.SnapshotGate(rows=5, seconds=60, clock=clock)
    assert not gate.add(5) and gate.add(1) and not gate.add(3)


def test_clean_url_files(spark, tmp_path):
    clean = spark.createDataFrame([("https://a", "a", "https://a/x")], "website string, domain string, original_url string")
    assert writers.write_clean_urls(clean, os.path.join(tmp_path, "c")) == (1, 1)


def test_streams(spark, tmp_path):
    src, log, ck = (os.path.join(tmp_path, n) for n in ("src", "log", "ck"))
    pair = "keyword string, href string"
    spark.createDataFrame([("k", "0")], pair).write.parquet(log)
    spark.createDataFrame([("k", "0"), ("k", "1"), ("k", "1")], pair).write.parquet(src)
    resume.log_progress(spark, src, pair, log, ck).awaitTermination()
    assert spark.read.parquet(log).count() == 2
    spark.createDataFrame([("k", "1"), ("k", "__SINGLE__")], pair).write.mode("append").parquet(src)
    resume.log_progress(spark, src, pair, log, ck).awaitTermination()
    assert sorted(r.href for r in spark.read.parquet(log).collect()) == ["0", "1", "__SINGLE__"]
    base, up = os.path.join(tmp_path, "base"), os.path.join(tmp_path, "up")
    spark.range(3).withColumn("v", F.lit("old")).write.parquet(base)
    spark.createDataFrame([(1, "new"), (9, "new")], "id bigint, v string").write.parquet(up)
    seen = []
    gate = writers.SnapshotGate(rows=1, seconds=0)
    resume.merge_results(spark, up, "id bigint, v string", base, "id", os.path.join(tmp_path, "ck2"), lambda d: seen.append(d.count()), gate).awaitTermination()
    assert {r.id: r.v for r in spark.read.parquet(base).collect()} == {0: "old", 1: "new", 2: "old", 9: "new"} and seen == [4]


def test_old_workbooks_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="old binary"):
        readers.table(spark, put(tmp_path, "a.xls", "x"))


def test_damaged_state_files(spark, tmp_path):
    aside, schema = os.path.join(tmp_path, "bad"), "a int, b string"
    whole = put(tmp_path, "w.csv", "a,b\n1,x\n")
    assert readers.csv_or_quarantine(spark, whole, schema, aside, "n").count() == 1 and not os.path.exists(aside)
    partly = put(tmp_path, "p.csv", "a,b\n1,x\nzz,y\n")
    assert [r.a for r in readers.csv_or_quarantine(spark, partly, schema, aside, "n").collect()] == [1]
    assert os.path.exists(partly) and os.listdir(aside) == ["p_n.csv"]
    gone = put(tmp_path, "g.csv", "a,b\nzz,y\n")
    assert readers.csv_or_quarantine(spark, gone, schema, aside, "n").count() == 0
    assert not os.path.exists(gone) and sorted(os.listdir(aside)) == ["g_n.csv", "p_n.csv"]


def test_resume_from_the_own_output(spark, tmp_path):
    assert readers.resumed(spark, os.path.join(tmp_path, "none.csv"), "Status Code") is None
    assert readers.resumed(spark, put(tmp_path, "o.csv", "Website\na\n"), "Status Code") is None
    assert readers.resumed(spark, put(tmp_path, "e.csv", "Website,Status Code\n"), "Status Code") is None
    assert readers.resumed(spark, put(tmp_path, "r.csv", "Website,Status Code\na,200\n"), "Status Code").count() == 1


@pytest.mark.parametrize("crash", ["before the renames", "between the renames"])
def test_a_crash_while_a_table_is_replaced(spark, tmp_path, crash):
    path = os.path.join(tmp_path, "t")
    spark.range(3).write.parquet(path)
    spark.range(5).write.parquet(f"{path}.next")
    if crash == "between the renames":
        os.rename(path, f"{path}.last")
    writers.recover_table(spark, path)
    assert spark.read.parquet(path).count() == (5 if crash == "between the renames" else 3)
    writers.replace_table(spark.read.parquet(path).where("id > 1"), path)
    assert sorted(os.listdir(tmp_path)) == ["t"]


def test_the_last_row_of_a_key_counts(spark, tmp_path):
    base, up = os.path.join(tmp_path, "base"), os.path.join(tmp_path, "up")
    spark.createDataFrame([(1, "start")], "id bigint, v string").write.parquet(base)
    spark.createDataFrame([(1, "old"), (2, "a"), (1, "new")], "id bigint, v string").coalesce(1).write.parquet(up)
    for ck in ("ck", "replayed"):
        resume.merge_results(spark, up, "id bigint, v string", base, "id", os.path.join(tmp_path, ck)).awaitTermination()
        assert {r.id: r.v for r in spark.read.parquet(base).collect()} == {1: "new", 2: "a"}


def test_a_replayed_batch_adds_no_pairs(spark, tmp_path):
    src, log = os.path.join(tmp_path, "src"), os.path.join(tmp_path, "log")
    pair = "keyword string, href string"
    spark.createDataFrame([], pair).write.parquet(log)
    spark.createDataFrame([("k", "1"), ("k", "2"), ("k", "1")], pair).write.parquet(src)
    for ck in ("a", "b"):
        resume.log_progress(spark, src, pair, log, os.path.join(tmp_path, ck)).awaitTermination()
        assert spark.read.parquet(log).count() == 2
