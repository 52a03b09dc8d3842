"""The queries of the subpackage on the smallest tables: those with an SQL twin against DuckDB, the others run and keep their columns."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from leadmill.llm import bpe, queries
from leadmill.session import data_dir

FOLDER = data_dir("sf0.001")
COLUMNS = {
    "p2_found": ["id", "field"], "p3_found": ["id_a", "id_b"], "p4_found": ["page_table", "id", "line_no"], "p5_found": ["first_id", "copy_id"],
    "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id"],
}


@pytest.mark.skipif(not os.path.isdir(FOLDER) or not os.path.exists(bpe.VOCABULARY), reason="no test tables or vocabulary")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    rows = df.collect()
    assert df.columns == COLUMNS.get(name, df.columns)
    if name in queries.SQL:
        c = duckdb.connect()
        for p in glob.glob(f"{FOLDER}/*.parquet"):
            c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
        got = c.execute(queries.SQL[name])
        order = [[d[0] for d in got.description].index(k) for k in df.columns]
        assert Counter(map(tuple, rows)) == Counter(tuple(r[k] for k in order) for r in got.fetchall())
