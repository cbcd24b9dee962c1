"""What must not be in any plan, and what must be."""

from tests.conftest import plan_of
from trustlake.operators.dedupe import dedupe
from trustlake.plans.datasets import CLAIMS, POLICIES, check
from trustlake.queries import bindings, quality

def test_scans_read_only_what_they_need(spark, small):
    plan = plan_of(bindings.table(spark, small, "orders").filter("o_totalprice > 5 + 3").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,8.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_checking_reads_every_table_once(spark, small):
    policies = check(POLICIES, bindings.raw_policies(spark, small))
    checked = check(CLAIMS, bindings.raw_claims(spark, small), {"policies": policies})
    plan = plan_of(checked)
    # orders play the claims and also date the policies
    assert plan.count("customer.parquet") == 1
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("orders.parquet") == 2
    assert "Window" not in plan


def test_dedupe_needs_one_shuffle(spark, small):
    lines = bindings.table(spark, small, "lineitem")
    plan = plan_of(dedupe(lines, ["l_orderkey", "l_linenumber"]))
    assert plan.count("Exchange") == 1
    assert plan.count("FileScan") == 1


def test_stored_feeds_are_checked_and_served_without_the_tables(spark, small, monkeypatch):
    """Training and requests of one query read the feeds from the same store."""
    silver, requests = bindings.silver(spark, small), quality.requests(spark, small)
    feeds = bindings.stored_feeds(spark, small)
    monkeypatch.setattr(bindings, "table", None)
    for found, wanted in zip((*bindings.silver(spark, small, feeds), quality.requests(spark, small, feeds)), (*silver, requests), strict=True):
        assert found.columns == wanted.columns and wanted.count() > 0
        assert found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0
