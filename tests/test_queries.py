"""Every query with an SQL twin against DuckDB on the smallest tables; the others run and keep their columns."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from leadmill.plans import catalog
from leadmill.session import data_dir

FOLDER = data_dir("sf0.001")


@pytest.fixture(scope="module")
def twin():
    c = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    shown = lambda v: round(v, 6) if isinstance(v, float) else v
    return Counter(tuple(str(shown(r[k])) for k in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, twin, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    rows = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    if name in catalog.SQL:
        got = twin.execute(catalog.SQL[name])
        columns = [d[0] for d in got.description]
        assert sorted(columns) == sorted(df.columns)
        assert normal(df.columns, rows) == normal(columns, got.fetchall())
