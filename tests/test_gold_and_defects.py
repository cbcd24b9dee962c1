import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trustlake.operators import gold
from trustlake.operators.defects import claim_defects, inject, inject_duplicates

DAY = datetime.date
POLICIES = [
    ("P1", "auto", "North", 40, DAY(2023, 1, 1), DAY(2024, 1, 1), 600.0),
    ("P2", "home", "South", None, DAY(2023, 1, 1), DAY(2024, 1, 1), 500.0),
]
POLICY_DDL = (
    "policy_id string, product string, region string, customer_age int, start_date date, end_date date, "
    "annual_premium double"
)
CLAIMS = [
    ("P1", "C1", DAY(2023, 1, 11), DAY(2023, 1, 14), 3600.0, "web", "x", 1),
    ("P1", "C2", DAY(2023, 1, 20), DAY(2023, 1, 20), 1800.0, "web", "x", 0),
    ("P1", "C3", DAY(2023, 2, 1), DAY(2023, 2, 3), 900.0, "app", "x", None),
    ("P2", "C4", DAY(2023, 2, 1), DAY(2023, 2, 3), 700.0, "app", "x", 0),
    ("P9", "C5", DAY(2023, 2, 1), DAY(2023, 2, 3), 700.0, "app", "x", 0),
]
CLAIM_DDL = (
    "policy_id string, claim_id string, incident_date date, report_date date, claim_amount double, channel string, "
    "description string, is_fraud int"
)


@pytest.fixture
def tables(spark):
    return spark.createDataFrame(CLAIMS, CLAIM_DDL), spark.createDataFrame(POLICIES, POLICY_DDL)


def test_features_by_hand(tables):
    rows = {r.claim_id: r for r in gold.fraud_features(*tables).collect()}
    assert rows.keys() == {"C1", "C2", "C3", "C4"}
    first = rows["C1"]
    assert (first.days_since_policy_start, first.report_delay_days) == (10, 3)
    assert (first.amount_vs_product_median, first.amount_vs_premium) == (2.0, 6.0)
    assert rows["C4"].amount_vs_product_median == 1.0
    assert gold.fraud_features(*tables).columns == ["claim_id", *gold.FEATURES, "is_fraud"]


def test_totals_are_never_those_of_a_part(spark, tables):
    """An amount without an exact decimal makes the total unknown instead of smaller."""
    claims, policies = tables
    for odd in (float("nan"), float("inf"), 1e23):
        amounts = F.when(F.col("claim_id") == "C1", F.lit(odd)).otherwise(F.col("claim_amount"))
        rows = gold.claims_monthly(claims.withColumn("claim_amount", amounts), policies).collect()
        unknown = [r for r in rows if str(r.month) == "2023-01-01" and r["product"] == "auto"]
        assert [(r.n_claims, r.total_amount, r.avg_amount) for r in unknown] == [(2, None, None)]
        assert all(r.total_amount is not None for r in rows if r not in unknown)


def test_monthly_by_hand(tables):
    rows = {(str(r.month), r.product): r for r in gold.claims_monthly(*tables).collect()}
    january = rows["2023-01-01", "auto"]
    assert (january.n_claims, january.total_amount, january.avg_amount, january.fraud_rate) == (2, 5400.0, 2700.0, 0.5)
    # a claim without a label counts as a claim but not in the rate
    assert rows["2023-02-01", "auto"].fraud_rate is None
    total = gold.monthly_rollup(gold.claims_monthly(*tables)).agg(F.sum("claims")).first()[0]
    assert total == 4


def test_rate_by_group_is_ordered(tables):
    ordered = gold.rate_by_group(gold.claim_records(*tables)).collect()
    rows = [(r["product"], r.claims, r.fraud_cases, r.fraud_rate_pct) for r in ordered]
    assert rows == [("auto", 3, 1, 50.0), ("home", 1, 0, 0.0)]


def test_frozen_medians(spark, tables):
    records = gold.claim_records(*tables).filter("product = 'auto'")
    medians = spark.createDataFrame([("auto", 1800.0)], "product string, product_median double")
    ratios = {r.claim_id: r.amount_vs_product_median for r in gold.claim_features(records, medians).collect()}
    assert ratios == {"C1": 2.0, "C2": 1.0, "C3": 0.5}
    single = gold.claim_features(records.filter("claim_id = 'C3'"), medians)
    assert single.first().amount_vs_product_median == 0.5


def test_unknown_products_are_refused_or_kept(spark, tables):
    records = gold.claim_records(*tables)
    medians = spark.createDataFrame([("auto", 1800.0)], "product string, product_median double")
    with pytest.raises(ValueError, match="home"):
        gold.claim_features(records, medians)
    kept = gold.claim_features(records, medians, on_unknown="keep")
    assert kept.filter("product = 'home'").first().amount_vs_product_median is None
    with pytest.raises(ValueError, match="on_unknown"):
        gold.claim_features(records, medians, on_unknown="guess")


def test_statistic_is_a_broadcast_not_a_window(tables):
    plan = plan_of(gold.fraud_features(*tables))
    assert "Window" not in plan
    assert "BroadcastHashJoin" in plan


def test_red_flags(spark):
    score = gold.red_flag_score("id > 0", "id > 1", "id > 2")
    values = [round(r[0], 4) for r in spark.range(4).select(score).collect()]
    assert values == [0.018, 0.0998, 0.4502, 0.7311]


def test_each_defect_hits_its_share(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("claim_id"),
        F.lit("P1").alias("policy_id"),
        F.lit(DAY(2023, 5, 20)).alias("incident_date"),
        F.lit(DAY(2023, 5, 21)).alias("report_date"),
        F.lit(10.0).alias("claim_amount"),
        F.lit("web").alias("channel"),
    )
    dirty = inject(rows, claim_defects(), "claim_id")
    assert dirty.dtypes == rows.dtypes
    counts = dirty.agg(
        *(
            F.count_if(F.expr(condition))
            for condition in (
                "claim_amount IS NULL",
                "channel IS NULL",
                "claim_amount < 0",
                "report_date = DATE'2023-05-10'",
                "policy_id = 'POL999999'",
            )
        )
    ).first()
    for n, share in zip(counts, (0.01, 0.01, 0.005, 0.005, 0.005), strict=True):
        assert n == pytest.approx(40_000 * share, rel=0.25)
    assert dirty.exceptAll(inject(rows.repartition(5), claim_defects(), "claim_id")).count() == 0


def test_duplicates_are_exact_and_cost_no_second_scan(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    doubled = inject_duplicates(orders, "o_orderkey", 0.1)
    assert doubled.distinct().count() == orders.count() < doubled.count()
    assert plan_of(doubled).count("FileScan") == 1
