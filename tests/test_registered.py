"""Every registered query against DuckDB on the smallest data set."""

import math
import os

import pytest

import __spark_entry__ as entry
from evlake.registered import ORACLES, QUERIES

DATA = os.environ.get("EVLAKE_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "events documents pages conversations".split()

pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(rows):
    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = plain(df.select(*[f"`{c}`" for c in columns]).collect())
    sql = ORACLES.get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == plain([tuple(r[i] for i in order) for r in cursor.fetchall()])


def test_all_are_handed_out():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
