"""States that are kept and merged must give what one pass over all rows gives."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trustlake.operators.gold import claims_monthly
from trustlake.operators.kept_rollup import SIGN, KeptMonthly, applied, superseding
from trustlake.operators.sketches import IDENTS, VALUES, daily_sketches, over_days, sketched_distinct, sketched_quantiles

CLAIM = "claim_id string, policy_id string, incident_date date, claim_amount double, is_fraud int, version int"
POLICY = "policy_id string, product string, region string, version int"


def claim_rows(spark, rows):
    text = ", ".join(CLAIM.replace(" date", " string").split(", "))
    return spark.createDataFrame(rows, text).withColumn("incident_date", F.col("incident_date").cast("date"))


def as_rows(df):
    return sorted(str(r) for r in df.collect())


def run(kept, number, claims, policies, new_claims, new_policies):
    claim_changes = superseding(claims, new_claims, ["claim_id"], ["version"])
    policy_changes = superseding(policies, new_policies, ["policy_id"], ["version"])
    kept.add(str(number), claims, claim_changes, policies, policy_changes)
    after = applied(claims, claim_changes, ["claim_id"]), applied(policies, policy_changes, ["policy_id"])
    return [spark_rows(df) for df in after]


def spark_rows(df):
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def test_superseding_by_hand(spark):
    kept = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0), (None, 1, 3.0)], "k string, version int, v double")
    # a newer row, an older one, an exact copy, a new key twice, rows without a key
    arrived = spark.createDataFrame(
        [("a", 2, 5.0), ("b", 1, 9.0), ("b", 2, 2.0), ("c", 1, 1.0), ("c", 1, 1.0), (None, 1, 3.0), (None, 1, 3.0)],
        kept.schema,
    )
    changes = superseding(kept, arrived, ["k"], ["version"])
    assert sorted(map(tuple, changes.collect()), key=str) == [
        ("a", 1, 1.0, -1), ("a", 2, 5.0, 1), ("c", 1, 1.0, 1), (None, 1, 3.0, 2),
    ]
    after = applied(kept, changes, ["k"])
    assert sorted(map(tuple, after.collect()), key=str) == [
        ("a", 2, 5.0), ("b", 2, 2.0), ("c", 1, 1.0), (None, 1, 3.0), (None, 1, 3.0), (None, 1, 3.0),
    ]
    assert superseding(kept, arrived.limit(0), ["k"]).count() == 0
    assert as_rows(applied(kept, changes.limit(0), ["k"])) == as_rows(kept)


@pytest.mark.parametrize("seed", [1, 2])
def test_states_of_many_runs_equal_one_pass(spark, tmp_path, seed):
    """Random rows: superseded, late policies, policies that move to another region, nulls, amounts without a decimal."""
    dice = random.Random(seed)
    amounts = [None, 0.1, 12.345678, -3.0, float("nan"), 1e25, 99999999.99]

    def some_claims(version):
        return [
            (
                dice.choice([None, *(f"c{i}" for i in range(12))]),
                dice.choice([None, "p1", "p2", "p3", "p4"]),
                dice.choice([None, "2024-01-05", "2024-01-31", "2024-02-01"]),
                dice.choice(amounts[: 4 if dice.random() < 0.8 else None]),
                dice.choice([None, 0, 1]),
                version,
            )
            for _ in range(8)
        ]

    def some_policies(version):
        return [(f"p{dice.randint(1, 4)}", dice.choice(["x", "y", None]), dice.choice(["n", "s"]), version) for _ in range(2)]

    kept = KeptMonthly(spark, str(tmp_path))
    assert kept.monthly().collect() == []
    claims, policies = claim_rows(spark, []), spark.createDataFrame([], POLICY)
    for number in range(3):
        new_claims = claim_rows(spark, some_claims(number) if number != 1 else [])
        new_policies = spark.createDataFrame(some_policies(number), POLICY)
        before = claims, policies
        claims, policies = run(kept, number, *before, new_claims, new_policies)
        assert as_rows(kept.monthly()) == as_rows(claims_monthly(claims, policies))
    # a repeated run overwrites its own states
    run(kept, number, *before, new_claims, new_policies)
    assert as_rows(kept.monthly()) == as_rows(claims_monthly(claims, policies))


def test_a_withdrawn_group_is_gone(spark, tmp_path):
    kept = KeptMonthly(spark, str(tmp_path))
    claims, policies = claim_rows(spark, []), spark.createDataFrame([], POLICY)
    policy = spark.createDataFrame([("p", "x", "n", 1)], POLICY)
    claims, policies = run(kept, 0, claims, policies, claim_rows(spark, [("c", "p", "2024-01-05", 1.0, 1, 1)]), policy)
    run(kept, 1, claims, policies, claim_rows(spark, [("c", "p", "2024-03-05", 1.0, 1, 2)]), policy)
    assert [str(r["month"]) for r in kept.monthly().collect()] == ["2024-03-01"]
    changes = superseding(claims, claims, ["claim_id"], ["version"])
    assert changes.count() == 0 and SIGN in changes.columns


def test_sketches_merge_over_any_range(spark):
    rows = spark.range(20000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('g', id % 5)) AS g",
        "date_add(DATE'2024-01-01', int(id % 40)) AS day",
        "if(id % 97 = 0, double('NaN'), if(id % 89 = 0, NULL, double(pmod(xxhash64(id), 1000)))) AS v",
        "id % 700 AS who",
    )
    states = over_days(daily_sketches(rows, ["g"], "day", "v", "who"), ["g"], "2024-01-05", "2024-01-20")
    inside = rows.filter("day BETWEEN '2024-01-05' AND '2024-01-20'")
    for row in sketched_quantiles(states, ["g"], (0.1, 0.5, 0.9)).collect():
        known = sorted(r["v"] for r in inside.filter("v < 1000").filter(F.col("g") == row["g"]).collect())
        below, reached = sum(v < row["value"] for v in known), sum(v <= row["value"] for v in known)
        assert below <= (row["probability"] + 0.01) * len(known) + 1
        assert reached >= (row["probability"] - 0.01) * len(known) - 1
    exact = {r["g"]: r["n"] for r in inside.groupBy("g").agg(F.countDistinct("who").alias("n")).collect()}
    assert {r["g"]: abs(r["idents"] / exact[r["g"]] - 1) < 0.06 for r in sketched_distinct(states, ["g"]).collect()} == dict.fromkeys(exact, True)
    # sketches are folded on the map side
    assert "partial_kll_sketch_agg" in plan_of(daily_sketches(rows, ["g"], "day", "v", "who"))


def test_sketches_of_days_without_values(spark):
    rows = spark.sql("SELECT 'a' AS g, DATE'2024-01-01' AS day, double(NULL) AS v, 1L AS who")
    daily = daily_sketches(rows, ["g"], "day", "v", "who")
    assert daily.first()[VALUES] is None and daily.first()["n_rows"] == 1 and daily.first()[IDENTS] is not None
    states = over_days(daily, ["g"], "2024-01-01", "2024-01-01")
    assert sketched_quantiles(states, ["g"], (0.5,)).first()["value"] is None
    assert sketched_distinct(states, ["g"]).first()["idents"] == 1
    more = daily.unionByName(daily_sketches(rows.withColumn("v", F.lit(7.0)), ["g"], "day", "v", "who"))
    assert sketched_quantiles(over_days(more, ["g"], "2024-01-01", "2024-01-01"), ["g"], (0.5,)).first()["value"] == 7.0
    assert over_days(daily, ["g"], "2025-01-01", "2025-01-02").count() == 0
