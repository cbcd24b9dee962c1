"""Every registered query against its SQL, and the driver's contract."""

import json
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tools.compare import TABLES, compare
from trustlake.queries import ORACLE, QUERIES

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, small, name):
    spark.sparkContext.setJobDescription(f"query {name}")
    good, note = compare(spark, duck, small, name)
    spark.sparkContext.setJobDescription(None)
    assert good, note


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas")


def executed_nodes(spark) -> dict[str, set[str]]:
    """By query: the operators of all plans that were really run, intermediate tables included."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    folder = Path(spark.conf.get("spark.eventLog.dir").removeprefix("file://"))
    found, names = {}, {}

    def walk(node: dict, into: set[str]) -> None:
        into.add(node["nodeName"])
        for child in node["children"]:
            walk(child, into)

    for log in folder.iterdir():
        for line in log.open():
            if "sparkPlanInfo" not in line:
                continue
            event = json.loads(line)
            names.setdefault(event["executionId"], event.get("description") or "")
            query = names[event["executionId"]].removeprefix("query ")
            if query in QUERIES:
                walk(event["sparkPlanInfo"], found.setdefault(query, set()))
    return found


def test_no_executed_plan_pairs_up_rows_or_runs_python(spark):
    """Over the plans of the queries that have run in this session."""
    seen = executed_nodes(spark)
    for query, nodes in seen.items():
        bad = {n for n in nodes for word in FORBIDDEN if word in n}
        # the one hook for a user's own reader
        assert bad <= ({"MapInPandas"} if query == "x8_batch_extractor" else set()), (query, bad)


def test_bench_and_contract_name_known_queries():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_bench_prints_one_json_line(small):
    env = {**os.environ, "BENCH_SF_DIR": small, "BENCH_CPUS": "2", "BENCH_QUERIES": "p2_normalise"}
    command = [sys.executable, "bench.py"]
    done = subprocess.run(command, cwd=ROOT, env=env, capture_output=True, text=True, timeout=300, check=True)
    result = json.loads(done.stdout)
    assert result["queries"].keys() == {"p2_normalise"}
    assert (result["unit"], result["sf"]) == ("sec", "0.001")
