"""Registered queries against their SQL at the smallest scale, and the entry points."""

import pathlib
import sys

import duckdb
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry
import check_oracle as co
from tests.conftest import DATA

NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in co.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_registry():
    assert set(entry.oracle_sql()) <= set(NAMES) and len(NAMES) > 120


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["feed_id", "report_date", "pick", "doc_id", "article_id", "importance", "score"] and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    df = entry.queries()[name](spark, DATA)
    got = co.rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got, f"{name} returns no row"
        return
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == co.rows(names, cursor.fetchall())
