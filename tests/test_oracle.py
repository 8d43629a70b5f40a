"""Every query that SQL can state, against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import FOLDER
from tools.check_oracle import TABLES, table


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(entry.oracle_sql()[name])
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert got[1] == want[1]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["age", "gender", "race"] and df.count() > 0
