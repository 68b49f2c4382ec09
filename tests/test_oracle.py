"""Every registered query against its SQL statement on an independent engine."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, compare
from paths import SMALL

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_oracles_name_registered_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, tables, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    verdict, _, _ = compare(spark, tables, name, lambda *_: df, ORACLE.get(name), SMALL)
    assert verdict.startswith(("ok", "rows-only")), verdict


def test_entry_has_rows_and_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["city", "state", "members_total", "members_active"]
    assert len(df.columns) == 26
    assert df.count() == 25
