"""Every registered query against its SQL counterpart, on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import TESTDATA

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="test data not present")

QUERIES, SQL = E.queries(), E.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in TESTDATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(rows, names):
    """Rows with columns by name, in a fixed order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, database, name):
    df = QUERIES[name](spark, str(TESTDATA))
    cursor = database.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    got = comparable([tuple(r) for r in df.collect()], df.columns)
    assert got == comparable(cursor.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql(spark, name):
    rows = QUERIES[name](spark, str(TESTDATA)).collect()
    assert rows and not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert rows and list(rows[0].asDict()) == ["year", "month", "year_month", "n_articles"]


def test_no_cross_joins(spark):
    """Plans of the queries pair no rows without a key."""
    for name in ("link_status", "bm25_topk", "hybrid_search", "version_counts", "monthly_trend_filled"):
        plan = QUERIES[name](spark, str(TESTDATA))._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
