import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, text_frame
from trustlake.operators.defects import claim_defects, inject, inject_duplicates
from trustlake.operators.rules import FAILED, QualityGateError
from trustlake.plans import medallion
from trustlake.plans.datasets import check
from trustlake.plans.medallion import MedallionConfig, main, run_medallion
from trustlake.session import shared_dir, work_dir
from trustlake.sources.raw import INGESTED_AT, MALFORMED, SOURCE_FILE, read_raw, with_lineage, write_raw
from trustlake.sources.storage import CatalogLayers, Snapshots, Storage, create_namespace, list_tables


@pytest.mark.parametrize(
    ("mode", "base", "layer", "name", "location"),
    [
        ("path", "data", "silver", "claims", "data/silver/claims"),
        ("path", "s3://bucket/lake/", "gold", "x", "s3://bucket/lake/gold/x"),
        ("table", "main.claims", "silver", "claims", "main.claims.silver_claims"),
        ("table", "main.claims", "gold", "claims_monthly", "main.claims.gold_claims_monthly"),
    ],
)
def test_locations(mode, base, layer, name, location):
    assert Storage(mode, base).location(layer, name) == location


@pytest.mark.parametrize("base", ["claims", "a.b.c", ".claims", "a. b"])
def test_table_base_has_two_parts(base):
    with pytest.raises(ValueError, match=r"catalog\.schema"):
        Storage("table", base)


def test_mode_and_format_are_checked():
    with pytest.raises(ValueError, match="mode"):
        Storage("cloud", "x")
    with pytest.raises(ValueError, match="format"):
        Storage("path", "x", "csv")


def test_raw_text_survives_a_round_trip(spark, folder):
    rows = [("1", 'say "hi", now'), ("2", "two\nlines"), ("3", None), ("4", " ")]
    write_raw(text_frame(spark, ["id", "t"], rows), f"{folder}/raw")
    assert sorted(map(tuple, read_raw(spark, f"{folder}/raw", multi_line=True).collect())) == rows
    named = with_lineage(read_raw(spark, f"{folder}/raw", ["id", "t"], multi_line=True))
    assert named.columns == ["id", "t", MALFORMED, SOURCE_FILE, INGESTED_AT]
    assert sorted(map(tuple, named.select("id", "t").collect())) == rows
    assert named.filter(F.col(SOURCE_FILE).contains("/raw/")).count() == 4


def test_csv_text_is_not_interpreted(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text('a,b\n001,""\n,"1,5"\n " ",x\n')
    frame = read_raw(spark, str(file))
    assert set(dict(frame.dtypes).values()) == {"string"}
    assert [tuple(r) for r in frame.collect()][:2] == [("001", None), (None, "1,5")]


def test_path_storage_overwrites_and_replaces_the_schema(spark, folder):
    storage = Storage("path", folder)
    storage.write(spark.range(5), "silver", "t")
    storage.write(spark.range(3).withColumn("x", F.lit(1)), "silver", "t")
    assert (storage.read(spark, "silver", "t").count(), storage.read(spark, "silver", "t").columns) == (3, ["id", "x"])
    storage.append(spark.range(2).withColumn("x", F.lit(1)), "silver", "t")
    assert storage.read(spark, "silver", "t").count() == 5


@pytest.fixture
def namespace(spark, folder):
    name = f"spark_catalog.t_{uuid.uuid4().hex[:8]}"
    create_namespace(spark, name, folder, "it's a test")
    create_namespace(spark, name, folder)
    return name


def test_table_storage_uses_real_tables(spark, namespace):
    storage = Storage("table", namespace)
    storage.write(spark.range(5), "silver", "t")
    storage.write(spark.range(3).withColumn("x", F.lit(1)), "silver", "t")
    assert spark.table(f"{namespace}.silver_t").count() == 3
    assert [r.tableName for r in list_tables(spark, namespace).collect()] == ["silver_t"]


def test_versions(spark, folder):
    lake = Snapshots(spark, folder)
    with pytest.raises(LookupError, match="silver.t"):
        lake.read("silver", "t")
    assert lake.write(spark.range(5), "silver", "t", "r1") == 0
    before = lake.read("silver", "t")
    # a table may be rebuilt from itself: the old files stay
    assert lake.write(before.filter("id > 1").withColumn("x", F.lit("a")), "silver", "t", "r2") == 1
    assert (lake.read("silver", "t").count(), lake.read("silver", "t", 0).count(), before.count()) == (3, 5, 5)
    assert lake.read("silver", "t").columns == ["id", "x"]
    assert [(r.version, r.run_id) for r in lake.history("silver", "t").orderBy("version").collect()] == [(0, "r1"), (1, "r2")]
    with pytest.raises(LookupError):
        lake.read("silver", "t", 2)
    assert Snapshots(spark, folder + "/").read("silver", "t").count() == 3


def test_a_table_without_rows_can_be_read(spark, folder):
    lake = Snapshots(spark, folder)
    lake.write(spark.range(0), "silver", "none")
    assert lake.read("silver", "none").count() == 0


def raw_feeds(spark, small):
    """Clean policies and claims from the given tables, with every kind of known defect."""
    customers = spark.read.parquet(f"{small}/customer.parquet")
    orders = spark.read.parquet(f"{small}/orders.parquet")
    policies = customers.select(
        F.concat(F.lit("POL"), "c_custkey").alias("policy_id"),
        F.col("c_mktsegment").alias("product"),
        F.col("c_nationkey").cast("string").alias("region"),
        F.lit("40").alias("customer_age"),
        F.lit("1994-01-01").alias("start_date"),
        F.lit("2005-01-01").alias("end_date"),
        F.lit("500").alias("annual_premium"),
    )
    day = F.col("o_orderdate").cast("date")
    claims = orders.select(
        F.concat(F.lit("C"), "o_orderkey").alias("claim_id"),
        F.concat(F.lit("POL"), "o_custkey").alias("policy_id"),
        day.alias("incident_date"),
        F.date_add(day, 2).alias("report_date"),
        F.col("o_totalprice").alias("claim_amount"),
        F.lit("web").alias("channel"),
        F.lit("Burst pipe.").alias("description"),
        (F.col("o_totalprice") > 400_000).cast("int").alias("is_fraud"),
    )
    dirty = inject_duplicates(inject(claims, claim_defects(), "claim_id"), "claim_id", 0.02)
    return {"policies": policies, "claims": dirty.select(*(F.col(c).cast("string") for c in dirty.columns))}


def check_run(spark, lake, outcome, feeds):
    claims = feeds["claims"]
    distinct = claims.distinct()
    ledger = outcome.ledgers["claims"]
    assert ledger.total_rows == distinct.count()
    assert ledger.duplicates_removed == claims.count() - distinct.count() > 0
    hits = ledger.failures_by_rule
    assert hits["claim_amount_present"] == distinct.filter("claim_amount IS NULL").count() > 0
    assert hits["claim_amount_positive"] == distinct.filter("claim_amount LIKE '-%'").count() > 0
    assert hits["reported_after_incident"] == distinct.filter("report_date < incident_date").count() > 0
    assert hits["policy_exists"] == distinct.filter("policy_id = 'POL999999'").count() > 0
    good, bad = lake.read("silver", "claims"), lake.read("quarantine", "claims")
    assert good.count() + bad.count() == ledger.total_rows
    assert bad.count() == ledger.quarantined_rows
    assert FAILED in bad.columns
    assert FAILED not in good.columns
    assert good.filter("claim_amount <= 0 OR claim_amount IS NULL").count() == 0
    assert lake.read("gold", "claims_monthly").agg(F.sum("n_claims")).first()[0] == good.count()
    assert lake.read("gold", "fraud_features").count() == good.count()
    report = lake.read_appended("reports", "quality")
    assert report.filter(F.col("run_id") == outcome.run_id).count() == 12


def test_run_with_folders(spark, small, folder):
    feeds = raw_feeds(spark, small)
    lake = Snapshots(spark, folder)
    outcome = run_medallion(spark, lake, feeds)
    check_run(spark, lake, outcome, feeds)
    again = run_medallion(spark, lake, feeds)
    assert again.report == outcome.report
    assert lake.history("silver", "claims").count() == 2
    assert lake.read("silver", "claims", 0).exceptAll(lake.read("silver", "claims")).count() == 0


def test_run_with_tables(spark, small, namespace):
    feeds = raw_feeds(spark, small)
    lake = CatalogLayers(spark, namespace)
    outcome = run_medallion(spark, lake, feeds)
    check_run(spark, lake, outcome, feeds)
    assert spark.table(f"{namespace}.silver_claims").count() == outcome.ledgers["claims"].valid_rows
    assert run_medallion(spark, lake, feeds).report == outcome.report


def test_failing_gate_publishes_nothing_but_keeps_the_evidence(spark, small, folder):
    feeds = raw_feeds(spark, small)
    lake = Snapshots(spark, folder)
    run_medallion(spark, lake, feeds)
    gold = lake.read("gold", "claims_monthly").count()
    broken = {**feeds, "claims": feeds["claims"].withColumn("claim_amount", F.lit("abc"))}
    with pytest.raises(QualityGateError) as error:
        run_medallion(spark, lake, broken)
    assert error.value.ledger.quarantine_rate == 1.0
    assert lake.history("silver", "claims").count() == lake.history("quarantine", "claims").count() == 1
    assert lake.read("gold", "claims_monthly").count() == gold
    assert lake.read_appended("reports", "quality").select("run_id").distinct().count() == 2
    assert lake.read("staged", "claims").filter(F.size(FAILED) > 0).count() == error.value.ledger.total_rows


def test_silver_read_prunes_the_quarantine_folder(spark, small, folder):
    lake = Snapshots(spark, folder)
    run_medallion(spark, lake, raw_feeds(spark, small))
    assert "PartitionFilters: [isnotnull(_outcome" in plan_of(lake.read("silver", "claims"))


def test_command_line(spark, small, folder, capsys):
    for name, frame in raw_feeds(spark, small).items():
        write_raw(frame, f"{folder}/raw/{name}.csv")
    assert main(["--base-path", folder]) == 0
    report = json.loads(capsys.readouterr().out)
    assert report["claims"]["valid_rows"] > 0
    assert main(["--base-path", folder, "--limit", "0.0001"]) == 1
    assert "Quality gate failed" in capsys.readouterr().out


def test_configuration():
    assert MedallionConfig().raw == "data/raw"
    assert MedallionConfig("s3://lake/").raw == "s3://lake/raw"
    with pytest.raises(ValueError, match="--raw-dir"):
        MedallionConfig(tables="main.claims").raw
    assert MedallionConfig(raw_dir="/x").raw == "/x"


def test_raw_files_in_any_column_order(spark, folder):
    """Two orders, a row cut short, a row too long, a file of other columns, a field with a comma."""
    files = {
        "a.csv": 'policy_id,product\np1,"x, y"\np2\n',
        "b.csv": "product,policy_id\nc2,p3\nc3,p4,more\n",
        "c.csv": "policy_id,colour\np5,red\n",
    }
    for name, text in files.items():
        (Path(folder) / name).write_text(text)
    rows = read_raw(spark, f"{folder}/*.csv", ["policy_id", "product"]).collect()
    assert sorted((r.policy_id, r["product"]) for r in rows if r[MALFORMED] is None) == [("p1", "x, y"), ("p3", "c2")]
    bad = sorted(r[MALFORMED] for r in rows if r[MALFORMED] is not None)
    assert bad == ["c3,p4,more", "no such header: p5,red", "no such header: policy_id,colour", "p2"]
    assert all(r.policy_id is None and r[SOURCE_FILE] for r in rows if r[MALFORMED] is not None)


def test_rows_that_look_like_a_header_are_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\na,b\n3,4\nb,a\n")
    (tmp_path / "y.csv").write_text("\ufeff b , a\r\n1,2\r\n")
    rows = read_raw(spark, str(tmp_path), ["a", "b"])
    assert sorted((r.a, r.b, r[MALFORMED]) for r in rows.collect()) == sorted(
        [("1", "2", None), ("a", "b", None), ("3", "4", None), ("b", "a", None), ("2", "1", None)]
    )


def test_reading_raw_rows_shuffles_nothing(spark, tmp_path):
    for number in range(3):
        (tmp_path / f"{number}.csv").write_text("a,b\n" + "1,2\n" * 50)
    (tmp_path / "same").mkdir()
    (tmp_path / "same" / "1.csv").write_text("b,a\n" + "1,2\n" * 50)
    one_layout = read_raw(spark, str(tmp_path / "[012].csv"), ["a", "b"])
    assert "Exchange" not in plan_of(one_layout) and one_layout.count() == 150
    several = read_raw(spark, f"{tmp_path}/{{0.csv,same}}", ["a", "b"])
    plan = plan_of(several)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert several.filter("a = 2").count() == 50


NASTY = ['plain', 'two\nlines', 'a "quoted" word', 'x\n\n"y"\n', ',', '"', ' lead', None, 'é\n日本', '\n' * 40, 'id,t']


def test_line_breaks_in_quoted_fields_across_splits(spark, folder):
    """Splits of a few bytes, so that most records lie in several of them."""
    rows = [(str(i), NASTY[i * 7 % len(NASTY)]) for i in range(110)]
    write_raw(text_frame(spark, ["id", "t"], rows).coalesce(1), f"{folder}/raw")
    expected = sorted(rows, key=repr)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("61", "500"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = read_raw(spark, f"{folder}/raw", ["t", "id"], multi_line=True)
            if size == "500":
                assert spark.read.text(f"{folder}/raw").rdd.getNumPartitions() > 3
            assert sorted(((r.id, r.t) for r in found.collect()), key=repr) == expected
            assert found.filter(f"{MALFORMED} IS NOT NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_multi_line_files_with_wrong_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\r\n"1\n2",x\r\nonly\r\n\r\n3,"4\n\n"\r\n')
    (tmp_path / "y.csv").write_text('a,c\n1,"2\n3"\n')
    rows = read_raw(spark, str(tmp_path), ["a", "b"], multi_line=True).collect()
    assert sorted((r.a, r.b) for r in rows if r[MALFORMED] is None) == [("1\n2", "x"), ("3", "4\n\n")]
    assert sorted(r[MALFORMED] for r in rows if r[MALFORMED]) == ["no such header: 1,2\n3", "no such header: a,c", "only"]


def test_malformed_rows_are_quarantined(spark, small, folder):
    feeds = raw_feeds(spark, small)
    for name, frame in feeds.items():
        write_raw(frame, f"{folder}/raw/{name}.csv")
    (Path(folder) / "raw" / "claims.csv" / "part-x.csv").write_text("C1,POL1\n")
    lake = Snapshots(spark, f"{folder}/lake")
    outcome = run_medallion(spark, lake, f"{folder}/raw")
    assert outcome.ledgers["claims"].failures_by_rule["row_readable"] == 1
    bad = lake.read("quarantine", "claims").filter(f"{MALFORMED} IS NOT NULL").collect()
    assert [(r[MALFORMED], r.claim_id, r[FAILED][0]) for r in bad] == [("C1,POL1", None, "row_readable")]
    assert MALFORMED not in lake.read("silver", "claims").columns
    assert lake.read("bronze", "claims").count() == feeds["claims"].count() + 1


def test_lost_rows_stop_the_run(spark, small, folder, monkeypatch):
    monkeypatch.setattr(medallion, "check", lambda *args: check(*args).filter("claim_id <> 'C1' OR claim_id IS NULL") if args[0].name == "claims" else check(*args))
    with pytest.raises(medallion.RowsLostError, match="claims"):
        run_medallion(spark, Snapshots(spark, folder), raw_feeds(spark, small))


def test_scratch_lives_in_the_shared_folder(spark):
    folder = f"{shared_dir(spark)}/trustlake/{spark.sparkContext.applicationId}"
    assert work_dir(spark, "a").startswith(f"{folder}/a-")
    assert work_dir(spark, "a") != work_dir(spark, "a")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("master", ["spark://somewhere:7077", "local-cluster[3,2,1000]", "yarn", ""])
def test_a_cluster_without_shared_folder_is_refused(master):
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return master if key == "spark.master" else default

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        shared_dir(Session())
