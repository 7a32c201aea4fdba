"""Every registered query against its SQL counterpart in DuckDB."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from siftmark.catalog.oracles import ORACLES
from siftmark.catalog.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda x: None if x is None else str(x + 0.0) if isinstance(x, float) else str(x)
    table = [tuple(cell(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(table, key=lambda r: [(x is None, x or "") for x in r])


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(ORACLES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, str(SF_DIR))
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = comparable(columns, cursor.fetchall())
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 20 and "composite_score" in df.columns
