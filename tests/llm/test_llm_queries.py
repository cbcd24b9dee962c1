"""The registered queries over the small tables, and SQL where SQL can tell."""

import duckdb
import pytest

from tools.compare import TABLES, compare
from trustlake.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small, name):
    good, note = compare(spark, duck, small, name)
    assert good, note


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op10_exact_dedup"])
def test_native_queries_run_no_python(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow") if word in plan]
