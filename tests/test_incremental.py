"""Runs over new files only must end with the tables of one run over all files."""

import pytest
from pyspark.sql import functions as F

from trustlake.operators.rules import QualityGateError
from trustlake.plans.incremental import ChangedFileError, KeptRows, list_files, run_incremental
from trustlake.plans.medallion import run_medallion
from trustlake.sources.storage import Snapshots

POLICY_HEADER = "policy_id,product,region,customer_age,start_date,end_date,annual_premium"
CLAIM_HEADER = "claim_id,policy_id,incident_date,report_date,claim_amount,channel,description,is_fraud"
TABLES = [("silver", "policies"), ("silver", "claims"), ("quarantine", "claims"), ("gold", "claims_monthly"), ("gold", "fraud_features")]

FIRST = {
    "policies": ["1,Home,North,40,2023-01-01,2024-01-01,500", "2,Motor,South,30,2023-01-01,2024-01-01,700"],
    "claims": [
        "10,1,2023-02-01,2023-02-03,100.5,web,first,0",
        "11,2,2023-03-01,2023-03-02,50,phone,second,1",
        # its policy comes with the second run
        "12,3,2023-03-05,2023-03-06,80,phone,third,0",
        ",1,2023-03-05,2023-03-06,80,phone,no key,0",
        ",1,2023-03-05,2023-03-06,80,phone,no key,0",
        "cut off",
    ],
}
SECOND = {
    "policies": ["3,Home,East,50,2023-01-01,2024-01-01,300"],
    "claims": [
        # supersedes a row, and lies in another month
        "11,2,2023-05-01,2023-05-02,60,phone,second,1",
        # an exact copy, an older version, a new key, one without a day
        "10,1,2023-02-01,2023-02-03,100.5,web,first,0",
        "12,3,2023-01-05,2023-01-06,80,phone,third,0",
        "13,1,2023-03-09,2023-03-10,20,web,fourth,0",
        "14,1,,2023-03-10,20,web,fifth,0",
        ",1,2023-03-05,2023-03-06,80,phone,no key,0",
    ],
}


def put(folder, number, feeds):
    for name, header in (("policies", POLICY_HEADER), ("claims", CLAIM_HEADER)):
        path = folder / f"{name}.csv"
        path.mkdir(parents=True, exist_ok=True)
        if name in feeds:
            (path / f"{number}.csv").write_text("\n".join([header, *feeds[name]]) + "\n")


def contents(lake):
    return {
        t: sorted(str(sorted(r.asDict().items(), key=str)) for r in lake.read(*t).collect()) for t in TABLES
    }


def full_run(spark, tmp_path, raw):
    lake = Snapshots(spark, str(tmp_path / "full"))
    outcome = run_medallion(spark, lake, str(raw), limit=1.0)
    return contents(lake), outcome.report


def test_two_runs_end_like_one(spark, tmp_path):
    raw, lake = tmp_path / "raw", Snapshots(spark, str(tmp_path / "lake"))
    kept = KeptRows(spark, str(tmp_path / "kept"))
    put(raw, 1, FIRST)
    assert run_incremental(spark, lake, kept, str(raw), limit=1.0)[1] == {"policies": 1, "claims": 1}
    put(raw, 2, SECOND)
    outcome, read = run_incremental(spark, lake, kept, str(raw), limit=1.0)
    assert read == {"policies": 1, "claims": 1}
    tables, report = full_run(spark, tmp_path, raw)
    assert contents(lake) == tables
    assert outcome.report == report
    # nothing new: nothing is published
    again, read = run_incremental(spark, lake, kept, str(raw), limit=1.0)
    assert not any(read.values()) and not again.staged
    # the raw rows of both runs are there, once
    assert spark.read.parquet(str(tmp_path / "kept/claims/raw")).count() == len(FIRST["claims"]) + len(SECOND["claims"])


def test_other_months_are_not_rewritten(spark, tmp_path):
    raw, kept = tmp_path / "raw", KeptRows(spark, str(tmp_path / "kept"))
    lake = Snapshots(spark, str(tmp_path / "lake"))
    put(raw, 1, FIRST)
    run_incremental(spark, lake, kept, str(raw), limit=1.0)
    months = tmp_path / "kept/claims/keyed"
    before = {p.parent.name: p.name for p in months.rglob("*.parquet")}
    put(raw, 2, {"claims": SECOND["claims"][:1]})
    assert run_incremental(spark, lake, kept, str(raw), limit=1.0)[1] == {"policies": 0, "claims": 1}
    after = {p.parent.name: p.name for p in months.rglob("*.parquet")}
    # the superseded row stays where its key was first filed
    assert {m for m in after if after[m] != before.get(m)} == {"_period=2023-03"}
    tables, _ = full_run(spark, tmp_path, raw)
    assert contents(lake) == tables


def test_a_run_that_was_broken_off_can_be_repeated(spark, tmp_path, monkeypatch):
    raw, kept = tmp_path / "raw", KeptRows(spark, str(tmp_path / "kept"))
    lake = Snapshots(spark, str(tmp_path / "lake"))
    put(raw, 1, FIRST)
    merge = KeptRows._merge

    def lost(self, spec, arrived):
        merge(self, spec, arrived)
        if spec.name == "claims":
            raise RuntimeError("driver lost")

    monkeypatch.setattr(KeptRows, "_merge", lost)
    with pytest.raises(RuntimeError, match="lost"):
        run_incremental(spark, lake, kept, str(raw), limit=1.0)
    monkeypatch.setattr(KeptRows, "_merge", merge)
    # more files arrive before it is repeated; the dataset that was done is not read again
    put(raw, 2, {"claims": SECOND["claims"]})
    outcome, read = run_incremental(spark, lake, kept, str(raw), limit=1.0)
    assert read == {"policies": 0, "claims": 2}
    tables, report = full_run(spark, tmp_path, raw)
    assert contents(lake) == tables and outcome.report == report


def test_odd_names_and_changed_files(spark, tmp_path):
    raw, kept = tmp_path / "raw", KeptRows(spark, str(tmp_path / "kept"))
    lake = Snapshots(spark, str(tmp_path / "lake"))
    put(raw, "a b[1]{x}", FIRST)
    assert run_incremental(spark, lake, kept, str(raw), limit=1.0)[1] == {"policies": 1, "claims": 1}
    assert kept.taken("claims").select("rows").first()[0] == len(FIRST["claims"])
    assert list_files(spark, str(raw / "claims.csv")).filter(F.col("length") > 0).count() == 1
    put(raw, "a b[1]{x}", {"claims": SECOND["claims"]})
    with pytest.raises(ChangedFileError, match="claims"):
        run_incremental(spark, lake, kept, str(raw), limit=1.0)


def test_files_that_met_the_gate_are_published_later(spark, tmp_path):
    raw, kept = tmp_path / "raw", KeptRows(spark, str(tmp_path / "kept"))
    lake = Snapshots(spark, str(tmp_path / "lake"))
    put(raw, 1, FIRST)
    with pytest.raises(QualityGateError):
        run_incremental(spark, lake, kept, str(raw), limit=0.01)
    assert kept.waiting().count() == 1
    outcome, read = run_incremental(spark, lake, kept, str(raw), limit=1.0)
    assert not any(read.values()) and kept.waiting().count() == 0
    tables, report = full_run(spark, tmp_path, raw)
    assert contents(lake) == tables and outcome.report == report
