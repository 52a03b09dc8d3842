"""Reading SQLite tables by ranges of row ids."""

import os
import sqlite3
from contextlib import closing

from leadmill.sources import sqlite


def test_read(spark, tmp_path):
    path = os.path.join(tmp_path, "s.db")
    with closing(sqlite3.connect(path)) as c:
        c.execute("CREATE TABLE websites (id INTEGER PRIMARY KEY, url TEXT NOT NULL, took REAL, at TIMESTAMP)")
        c.executemany("INSERT INTO websites VALUES (?, ?, ?, ?)", [(k, f"https://h{k}.example", k / 2, None if k % 2 else "2026-01-01") for k in range(1, 102)])
        c.execute("CREATE TABLE unused (a TEXT)")
        c.commit()
    df = sqlite.read(spark, path, "websites", 4)
    assert [t for _, t in df.dtypes] == ["bigint", "string", "double", "string"]
    assert df.count() == 101 and df.rdd.getNumPartitions() == 4
    assert df.where("id = 100").first().asDict() == {"id": 100, "url": "https://h100.example", "took": 50.0, "at": "2026-01-01"}
    assert sqlite.read(spark, path, "unused").count() == 0
