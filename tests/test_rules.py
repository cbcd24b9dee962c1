import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, text_frame
from trustlake.operators.dedupe import COPIES
from trustlake.operators.rules import (
    FAILED,
    POLICY_RULES,
    REQUEST_RULES,
    Ledger,
    QualityGateError,
    Rule,
    apply_rules,
    failures_by_rule,
    gate,
    ledger_columns,
    ledger_frame,
    member_of,
    observe_ledger,
    quarantine_reasons,
    split_valid,
)
from trustlake.operators.scoring import normalise_requests
from trustlake.plans.datasets import CLAIMS, POLICIES, check

POLICY_COLUMNS = ["policy_id", "product", "region", "customer_age", "start_date", "end_date", "annual_premium"]
CLAIM_COLUMNS = [
    "claim_id",
    "policy_id",
    "incident_date",
    "report_date",
    "claim_amount",
    "channel",
    "description",
    "is_fraud",
]
GOOD_POLICY = ("D1", " Auto", "North", "41", "2022-05-01", "2023-05-01", "480.5")
GOOD_CLAIM = {
    "claim_id": "F1",
    "policy_id": "D1",
    "incident_date": "2022-06-01",
    "report_date": "2022-06-03",
    "claim_amount": "750.25",
    "channel": " Web ",
    "description": "x",
    "is_fraud": "0",
}


def policies(spark, *rows):
    return check(POLICIES, text_frame(spark, POLICY_COLUMNS, list(rows)))


def claims(spark, *overrides):
    rows = [tuple({**GOOD_CLAIM, **o}[c] for c in CLAIM_COLUMNS) for o in overrides]
    known = split_valid(policies(spark, GOOD_POLICY, ("D9", "home", "South", "30", "2022-01-01", "2022-06-01", "-1")))[0]
    return check(CLAIMS, text_frame(spark, CLAIM_COLUMNS, rows), {"policies": known})


def broken(frame, key):
    return {r[key]: r[FAILED] for r in frame.collect()}


def test_policies_by_hand(spark):
    found = policies(
        spark,
        GOOD_POLICY,
        ("D2", "home", "South", None, "2022-07-15", "2022-07-15", "700"),
        ("D3", "home", "South", "x", "2022-13-40", "2023-01-01", "-1"),
    )
    assert broken(found, "policy_id") == {
        "D1": [],
        "D2": ["end_after_start"],
        "D3": ["start_date_valid", "end_after_start", "premium_positive"],
    }
    assert found.filter("policy_id = 'D1'").first()["product"] == "auto"


@pytest.mark.parametrize(
    ("override", "rules"),
    [
        ({}, []),
        ({"claim_amount": None}, ["claim_amount_present"]),
        ({"claim_amount": "-50"}, ["claim_amount_positive"]),
        ({"claim_amount": "0"}, ["claim_amount_positive"]),
        ({"claim_amount": "abc"}, ["claim_amount_present"]),
        ({"incident_date": "not-a-date"}, ["incident_date_valid", "reported_after_incident"]),
        ({"report_date": "2022-05-20"}, ["reported_after_incident"]),
        ({"report_date": None}, ["reported_after_incident"]),
        ({"policy_id": "nobody"}, ["policy_exists"]),
        ({"policy_id": "D9"}, ["policy_exists"]),
        ({"policy_id": None}, ["policy_exists"]),
        ({"channel": None}, []),
        ({"claim_amount": "NaN"}, ["claim_amount_finite"]),
        ({"claim_amount": "Infinity"}, ["claim_amount_finite"]),
        ({"claim_amount": "-Infinity"}, ["claim_amount_positive", "claim_amount_finite"]),
    ],
)
def test_claims_by_hand(spark, override, rules):
    row = claims(spark, override).first()
    assert row[FAILED] == rules
    assert row["channel"] == ("unknown" if "channel" in override else "web")


def test_types_of_silver_claims(spark):
    kinds = dict(claims(spark, {}).dtypes)
    assert (kinds["claim_amount"], kinds["incident_date"], kinds["is_fraud"]) == ("double", "date", "int")
    assert kinds[FAILED] == "array<string>"


def test_copies_are_folded_and_keyless_rows_are_not(spark):
    found = claims(spark, {}, {}, {"claim_id": None}, {"claim_id": None})
    rows = sorted((r["claim_id"] or "", r[FAILED], r[COPIES]) for r in found.collect())
    assert rows == [("", ["claim_id_present"], 1), ("", ["claim_id_present"], 1), ("F1", [], 2)]


def test_null_counts_as_broken_and_order_is_declaration_order(spark):
    rules = [Rule("b", "CAST(NULL AS BOOLEAN)"), Rule("a", "id < 0"), Rule("c", "id = 0")]
    assert apply_rules(spark.range(1), rules).first()[FAILED] == ["b", "a"]
    with pytest.raises(ValueError, match="unique"):
        apply_rules(spark.range(1), [Rule("a", "true"), Rule("a", "true")])


def test_split_covers_everything(spark):
    checked = apply_rules(spark.range(10), [Rule("small", "id < 7")])
    good, bad = split_valid(checked)
    assert (good.columns, good.count(), bad.count()) == (["id"], 7, 3)
    assert FAILED in bad.columns


RULES = [Rule("small", "id < 7"), Rule("odd", "id % 2 = 1"), Rule("any", "true")]


def test_ledger_in_one_pass(spark):
    checked = apply_rules(spark.range(10), RULES).withColumn(COPIES, F.lit(2))
    counts = checked.agg(*ledger_columns(RULES, COPIES)).first().asDict()
    ledger = Ledger.from_counts("numbers", counts, RULES)
    assert ledger.as_dict() == {
        "total_rows": 10,
        "valid_rows": 3,
        "quarantined_rows": 7,
        "quarantine_rate": 0.7,
        "failures_by_rule": {"small": 3, "odd": 5, "any": 0},
        "duplicates_removed": 10,
    }
    assert {r.rule: r.failed_rows for r in failures_by_rule(checked, RULES).collect()} == {"small": 3, "odd": 5, "any": 0}
    assert ledger_frame(checked, RULES, COPIES).first().asDict() == {
        "total_rows": 10,
        "quarantined_rows": 7,
        "duplicates_removed": 10,
        "valid_rows": 3,
        "quarantine_rate": 0.7,
    }
    _, bad = split_valid(checked)
    assert [(r["rule"], r["rows"]) for r in quarantine_reasons(bad).collect()] == [("odd", 5), ("small", 3)]


def test_observed_counts_equal_counted_ones(spark, folder):
    checked = apply_rules(spark.range(1000).repartition(5), RULES)
    observed, counts = observe_ledger(checked, RULES)
    observed.write.parquet(f"{folder}/out")
    assert counts.get == checked.agg(*ledger_columns(RULES)).first().asDict()


def test_empty_input_has_rate_zero(spark):
    checked = apply_rules(spark.range(0), RULES).withColumn(COPIES, F.lit(1))
    counts = checked.agg(*ledger_columns(RULES, COPIES)).first().asDict()
    ledger = Ledger.from_counts("none", counts, RULES)
    assert (ledger.quarantine_rate, ledger.duplicates_removed) == (0.0, 0)
    gate(ledger)


def test_gate_counts():
    gate(Ledger("c", 100_000, 5_000, {}), 0.05)
    with pytest.raises(QualityGateError, match="5001 of 100000 rows quarantined"):
        gate(Ledger("c", 100_000, 5_001, {}), 0.05)


def test_rules_stay_in_generated_code(spark, small):
    frame = spark.read.parquet(f"{small}/orders.parquet")
    assert "*(1) Project" in plan_of(apply_rules(frame, [Rule("a", "o_totalprice > 5"), Rule("b", "o_orderkey > 1")]))


def test_member_of_quotes_text(spark):
    assert spark.range(1).select(F.expr(member_of("'it''s'", ["it's", "b"]))).first()[0] is True


GOOD_REQUEST = {
    "claim_id": "R1",
    "product": " Auto ",
    "region": "Madrid",
    "channel": "WEB",
    "customer_age": 40.0,
    "claim_amount": 900.0,
    "annual_premium": 600.0,
    "policy_start_date": "2024-01-01",
    "incident_date": "2024-05-10",
    "report_date": "2024-05-12",
}


@pytest.mark.parametrize(
    ("override", "rules"),
    [
        ({}, []),
        ({"claim_id": ""}, ["claim_id_present"]),
        ({"product": "pet"}, ["product_known"]),
        ({"region": "Atlantis"}, ["region_known"]),
        ({"channel": "fax"}, ["channel_known"]),
        ({"channel": None}, []),
        ({"customer_age": 17.0}, ["age_in_range"]),
        ({"claim_amount": 0.0}, ["claim_amount_positive"]),
        ({"annual_premium": 0.0}, ["premium_positive"]),
        ({"incident_date": "2024-13-45"}, ["incident_date_valid", "reported_after_incident"]),
        ({"report_date": "2024-05-09"}, ["reported_after_incident"]),
    ],
)
def test_requests_by_hand(spark, override, rules):
    row = {**GOOD_REQUEST, **override}
    kinds = {"customer_age": "double", "claim_amount": "double", "annual_premium": "double"}
    raw = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in row))
    dates = ("policy_start_date", "incident_date", "report_date")
    typed = raw.withColumns({c: F.col(c).try_cast("date") for c in dates})
    assert apply_rules(normalise_requests(typed), REQUEST_RULES).first()[FAILED] == rules


def test_rule_names_are_unique():
    for rules in (POLICY_RULES, CLAIMS.rules, REQUEST_RULES):
        assert len({r.name for r in rules}) == len(rules)
