"""Every query with SQL gives the rows that SQL gives in another engine."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF_DIR}/{name}'")
    return con


def _text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = df.collect()
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    assert sorted(tuple(_text(r[c]) for c in order) for r in got) == sorted(
        tuple(_text(r[i]) for i in at) for r in want
    )


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert df.limit(1).count() == 1 and "coloc_h4" in df.columns
