import json

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.test_storage_and_medallion import raw_feeds
from trustlake.functions.hashing import keyed_hash
from trustlake.operators import gold, models
from trustlake.operators.defects import Defect, inject, inject_duplicates
from trustlake.operators.extraction import attach, extract_distinct, extract_rows, keyword_extractor
from trustlake.operators.categories import category_places, known_categories, with_places
from trustlake.operators.models import (
    class_weights,
    classifier,
    fingerprint,
    exact_medians,
    preparation,
    prepare_features,
    relative_to,
    train,
)
from trustlake.operators.rules import FAILED, Rule, apply_rules, request_rules, split_valid
from trustlake.operators.scoring import check_requests, rejection_reasons, score_batch
from trustlake.operators.selection import stratified_split
from trustlake.plans.serving import serve_batch, serve_triage
from trustlake.plans.training import main as training_main
from trustlake.plans.training import run_all, train_and_register
from trustlake.sources.logs import append_log, extraction_log, prediction_log
from trustlake.sources.registry import ModelRegistry, champion, parse_uri
from trustlake.sources.storage import Snapshots
from trustlake.streaming import jobs
from trustlake.streaming.jobs import read_checked, read_report, read_scored, stream_quality, stream_score

QUICK = {"logistic_regression": {"max_iter": 30}, "gradient_boosting": {"max_iter": 5}}
REGIONS = ("North", "South")


def feature_table(spark, rows=3000):
    """Claims with three red flags and a label that follows them."""
    base = spark.range(rows).select(F.format_string("C%06d", "id").alias("claim_id"), F.col("id").alias("i"))

    def draw(name):
        return F.conv(F.substring(keyed_hash(name, "i"), 1, 8), 16, 10).cast("double") / 16**8

    drawn = base.select(
        "claim_id",
        F.when(draw("p") < 0.6, "auto").otherwise("home").alias("product"),
        F.when(draw("r") < 0.5, "North").otherwise("South").alias("region"),
        F.when(draw("c") < 0.5, "web").otherwise("phone").alias("channel"),
        F.floor(18 + 60 * draw("a")).cast("int").alias("customer_age"),
        F.round(500 + 4000 * draw("m") * draw("m2"), 2).alias("claim_amount"),
        F.round(300 + 600 * draw("q"), 2).alias("annual_premium"),
        F.floor(365 * draw("d")).cast("int").alias("days"),
        F.floor(30 * draw("e")).cast("int").alias("delay"),
        draw("y").alias("y"),
    )
    start = F.lit("2024-01-01").cast("date")
    records = drawn.select(
        "*",
        start.alias("start_date"),
        F.date_add(start, F.col("days")).alias("incident_date"),
        F.date_add(start, F.col("days") + F.col("delay")).alias("report_date"),
    )
    features = gold.claim_features(records.withColumn("is_fraud", F.lit(0)), gold.group_medians(records), keep=["y"])
    risk = gold.red_flag_score(
        "days_since_policy_start < 60", "amount_vs_product_median > 2", "report_delay_days > 20"
    )
    return records, features.withColumn("is_fraud", (F.col("y") < risk).cast("int")).drop("y")


@pytest.fixture(scope="module")
def data(spark):
    records, features = feature_table(spark)
    return records.cache(), features.cache()


@pytest.fixture(scope="module")
def registry(spark, data, tmp_path_factory):
    store = ModelRegistry(spark, str(tmp_path_factory.mktemp("registry")))
    results, best, version = train_and_register(data[1], store, "m", review_rate=0.1, params=QUICK)
    return store, results, best, version


@pytest.fixture(scope="module")
def scorer(registry):
    loaded = registry[0].load("m")
    loaded.rules = request_rules(("auto", "home", "travel"), REGIONS, ("web", "phone", "unknown"))
    return loaded


def test_missing_feature_columns(data):
    with pytest.raises(ValueError, match="channel.*is_fraud"):
        prepare_features(data[1].drop("channel", "is_fraud"))
    assert dict(prepare_features(data[1]).dtypes)["customer_age"] == "double"


def test_class_weights(spark):
    frame = spark.range(100).select((F.col("id") < 10).cast("int").alias("y"))
    assert class_weights(frame, "y") == {1: 5.0, 0: pytest.approx(100 / 180)}
    with pytest.raises(ValueError, match="both 0 and 1"):
        class_weights(frame.filter("y = 0"), "y")


def test_the_fitted_preparation(spark):
    """An unknown category is zero everywhere, numbers are in population deviations, a constant one is zero."""
    rows = [("a", 1.0, 7.0), ("a", 3.0, 7.0), ("b", None, 7.0)]
    frame = spark.createDataFrame(rows, "c string, x double, k double")
    model = Pipeline(stages=preparation(known_categories(frame, ["c"]), exact_medians(frame, ["x", "k"]), 3)).fit(frame)
    new = spark.createDataFrame([("a", 1.0, 7.0), ("b", 3.0, 7.0), ("z", None, 7.0), (None, 1.0, 7.0)], frame.schema)
    found = [(list(r.c_hot.toArray()), r.scaled.toArray()) for r in model.transform(new).collect()]
    assert [hot for hot, _ in found] == [[1, 0], [0, 1], [0, 0], [0, 0]]
    x = np.array([1.0, 3.0, 2.0])  # the missing number is the median of the known ones, between them
    expected = [(v - x.mean()) / x.std() for v in (1.0, 3.0, 2.0, 1.0)]
    assert [s[0] for _, s in found] == pytest.approx(expected)
    assert {s[1] for _, s in found} == {0.0}


def test_category_places(spark):
    """Frequent ones first, then by name; missing and unknown ones have no place; a column may have any number of them."""
    rows = [("b", i, "x'") for i in range(5)] + [("a", i % 3, None) for i in range(5)] + [(None, None, "")]
    frame = spark.createDataFrame(rows, "c string, n int, other string").repartition(3)
    places = category_places(frame, ["c", "n", "other"])
    found = {(r["column"], r.category): (r.n, r.place) for r in places.collect()}
    assert found == {
        ("c", "a"): (5, 0), ("c", "b"): (5, 1), ("n", "0"): (3, 0), ("n", "1"): (3, 1), ("n", "2"): (2, 2),
        ("n", "3"): (1, 3), ("n", "4"): (1, 4), ("other", "x'"): (5, 0), ("other", ""): (1, 1),
    }
    new = spark.createDataFrame([("a", 4), ("z", None)], "c string, n int")
    assert sorted((r.c, r.c_place, r.n_place) for r in with_places(new, places, ["c", "n"]).collect()) == [("a", 0, 4), ("z", None, None)]
    assert known_categories(frame, ["c", "n"]) == {"c": ["a", "b"], "n": ["0", "1", "2", "3", "4"]}
    with pytest.raises(ValueError, match=r"at most 4 a column: n \(5\)"):
        known_categories(frame, ["c", "n"], most=4)


def test_a_native_reader_moves_nothing(spark):
    rows = [(1, "  A car crash. Someone was hurt. "), (2, None), (3, "water in the house"), (4, "water in the house")]
    frame = spark.createDataFrame(rows, "id int, text string")
    inline = extract_rows(frame, "text", keyword_extractor())
    assert "Exchange" not in plan_of(inline)
    apart = attach(frame, "text", extract_distinct(frame, "text", keyword_extractor())[0])
    assert sorted(map(tuple, inline.collect())) == sorted(map(tuple, apart.select(*inline.columns).collect()))


def test_rows_without_a_label_are_left_out(data):
    some = data[1].withColumn("is_fraud", F.when(F.col("claim_id") > "C000100", F.col("is_fraud")))
    trained = train(some, ["logistic_regression"], params=QUICK)["logistic_regression"]
    assert trained.n_unlabelled == 101 and trained.n_train + trained.n_test == 3000 - 101


def test_fingerprint_ignores_order_and_sees_changes(spark):
    frame = spark.range(1000)
    assert fingerprint(frame) == fingerprint(frame.repartition(7))
    assert fingerprint(frame) != fingerprint(frame.withColumn("id", F.col("id") + 1))
    assert fingerprint(spark.range(0))["rows"] == 0
    one = spark.createDataFrame([("x", None)], "a string, b string")
    assert fingerprint(one) != fingerprint(spark.createDataFrame([(None, "x")], "a string, b string"))


def test_unknown_models_and_options(data):
    with pytest.raises(ValueError, match="oracle"):
        classifier("oracle", 1.0)
    with pytest.raises(ValueError, match="stats_from"):
        train(data[1], stats_from="test")


def test_both_models_rank_better_than_chance(registry):
    _, results, best, version = registry
    assert set(results) == {"logistic_regression", "gradient_boosting"}
    for trained in results.values():
        base_rate = 1 - trained.metrics["accuracy_if_never_fraud"]
        assert trained.metrics["pr_auc"] > 1.3 * base_rate
        assert trained.metrics["roc_auc"] > 0.55
        assert trained.n_train + trained.n_test == 3000
    # the linear scores have hardly any ties, so the flagged share is close to the wanted one
    assert results["logistic_regression"].metrics["flagged_rate"] == pytest.approx(0.1, abs=0.035)
    assert best == max(results, key=lambda n: (results[n].metrics["pr_auc"], n))
    assert version == 1


def test_medians_rebuild_the_gold_column(registry, data):
    _, results, _, _ = registry
    medians = results["logistic_regression"].medians
    rebuilt = gold.claim_features(data[0].withColumn("is_fraud", F.lit(0)), medians)
    columns = ["claim_id", "amount_vs_product_median"]
    assert rebuilt.select(columns).exceptAll(data[1].select(columns)).count() == 0


def test_rows_are_stored_with_one_vector_a_model(spark, data, monkeypatch):
    kinds = []

    def cut(frame, store=models.lineage_cut):
        kinds.append([f.dataType.typeName() for f in frame.schema.fields].count("vectorudt"))
        return store(frame)

    monkeypatch.setattr(models, "lineage_cut", cut)
    train(data[1], ["logistic_regression"], params=QUICK)
    assert max(kinds) == 1


def test_statistics_of_the_training_rows_only(spark, data):
    trained = train(data[1], ["logistic_regression"], params=QUICK, stats_from="train")["logistic_regression"]
    rows = stratified_split(data[1], "is_fraud", "claim_id").filter("NOT is_test")
    assert trained.medians.exceptAll(gold.group_medians(rows)).count() == 0
    assert trained.medians.exceptAll(gold.group_medians(data[1])).count() > 0
    moved = relative_to(data[1], trained.medians, "product", "claim_amount")
    assert moved.columns == data[1].columns
    assert moved.exceptAll(data[1]).count() > 0


def test_runs_record_everything(registry):
    store, results, _, _ = registry
    rows = {r.model_type: r for r in store.runs().collect()}
    assert rows.keys() == results.keys()
    row = rows["logistic_regression"]
    assert row.metrics["pr_auc"] == results["logistic_regression"].metrics["pr_auc"]
    assert json.loads(row.params) == {"C": 1.0, "max_iter": 30}
    assert (row.n_train + row.n_test, row.data_rows) == (3000, 3000)
    assert len({r.data_checksum for r in rows.values()}) == 1


def test_alias_moves_and_rolls_back(registry):
    store, results, best, _ = registry
    other = next(n for n in results if n != best)
    runs = {r.model_type: r.run_id for r in store.runs().collect()}
    assert store.move_alias("m", runs[other], "trial") == 2
    assert store.load("m", "trial").model_type == other
    store.move_alias("m", runs[best], "trial", version=1)
    loaded = store.load("m", "trial")
    assert (loaded.model_type, loaded.version) == (best, "1")
    assert loaded.threshold == results[best].threshold
    with pytest.raises(LookupError, match="nobody"):
        store.load("m", "nobody")


def test_champion_breaks_ties_reproducibly(spark):
    frame = spark.createDataFrame([("a", 0.5), ("c", 0.7), ("b", 0.7)], "name string, pr_auc double")
    assert champion(frame, "pr_auc").first().name == "c"


def test_uris():
    assert parse_uri("models:/claims@champion") == ("claims", "champion")
    for wrong in ("claims@champion", "models:/claims", "models:/@x", "models:/x@"):
        with pytest.raises(ValueError, match="models:/<name>@<alias>"):
            parse_uri(wrong)


def requests_of(records):
    return records.withColumnRenamed("start_date", "policy_start_date")


def test_batch_scores(data, scorer):
    scored, rejected = score_batch(requests_of(data[0]), scorer)
    rows = scored.collect()
    assert len(rows) == 3000
    assert rejected.count() == 0
    assert all(0 <= r.fraud_score <= 1 and r.fraud_score == pytest.approx(r.raw_score, abs=5e-5) for r in rows)
    assert all(r.flag_for_review == (r.raw_score >= scorer.threshold) for r in rows)
    assert {(r.threshold, r.model_version) for r in rows} == {(scorer.threshold, "1")}
    one = score_batch(requests_of(data[0]).filter("claim_id = 'C000007'"), scorer)[0].first()
    assert one == next(r for r in rows if r.claim_id == "C000007")


def test_red_flags_raise_the_score(spark, data, scorer):
    calm = requests_of(data[0]).limit(1)
    day = F.lit("2024-01-01").cast("date")
    calm = calm.withColumns({"claim_id": F.lit("calm"), "claim_amount": F.lit(900.0), "policy_start_date": day})
    calm = calm.withColumns({"incident_date": F.date_add(day, 200), "report_date": F.date_add(day, 202)})
    wild = calm.withColumns({"claim_id": F.lit("wild"), "claim_amount": F.lit(4400.0)})
    wild = wild.withColumns({"incident_date": F.date_add(day, 5), "report_date": F.date_add(day, 33)})
    scores = {r.claim_id: r.raw_score for r in score_batch(calm.unionByName(wild), scorer)[0].collect()}
    assert scores["wild"] > scores["calm"]


def test_untidy_requests_score_like_tidy_ones(data, scorer):
    tidy = requests_of(data[0]).filter("claim_id < 'C000050'")
    untidy = tidy.withColumns({c: F.concat(F.lit(" "), F.upper(c), F.lit(" ")) for c in ("product", "channel")})
    assert score_batch(untidy, scorer)[0].exceptAll(score_batch(tidy, scorer)[0]).count() == 0


def test_rejected_requests_say_why(data, scorer):
    some = requests_of(data[0]).limit(3)
    bad = some.withColumns({"product": F.lit("pet"), "claim_amount": F.lit(0.0)})
    scored, rejected = score_batch(bad, scorer)
    assert scored.count() == 0
    reasons = {r.reasons for r in rejection_reasons(rejected).collect()}
    assert reasons == {"product_known, claim_amount_positive, product_has_median"}
    # allowed by the closed list, yet never seen in training
    unseen = check_requests(some.withColumn("product", F.lit("travel")), scorer)
    assert {tuple(r[FAILED]) for r in unseen.collect()} == {("product_has_median",)}


def test_no_requests_no_scores(data, scorer):
    scored, rejected = score_batch(requests_of(data[0]).limit(0), scorer)
    assert (scored.count(), rejected.count()) == (0, 0)


def test_scoring_shuffles_nothing(spark, data, scorer, tmp_path):
    requests_of(data[0]).write.parquet(str(tmp_path / "r"))
    plan = plan_of(score_batch(spark.read.parquet(str(tmp_path / "r")), scorer)[0])
    assert "Exchange hashpartitioning" not in plan


def test_log_records(spark, data, scorer, tmp_path):
    scored, _ = score_batch(requests_of(data[0]).limit(5), scorer)
    records = prediction_log(scored, 12.5, 5)
    append_log(records, str(tmp_path / "log"))
    append_log(records, str(tmp_path / "log"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert len(lines) == 10
    assert list(lines[0]) == ["claim_id", "fraud_score", "flagged", "model_version", "latency_ms", "batch_size"]
    ddl = "claim_id string, extractor string, damage_type string, urgency string, needs_manual_review boolean"
    read = spark.createDataFrame([("C1", "fake", "fire", "low", False)], ddl)
    assert json.loads(extraction_log(read, 1.0).first().record)["extraction_ms"] == 1.0


def test_stream_scores_equal_batch_scores(spark, data, scorer, tmp_path):
    wanted = requests_of(data[0])
    wanted = wanted.withColumn("product", F.when(F.col("customer_age") == 30, "pet").otherwise(F.col("product")))
    arriving, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    wanted.repartition(3).write.parquet(arriving)

    def run():
        stream = spark.readStream.schema(wanted.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
        stream_score(stream, scorer, target, offsets).awaitTermination()
        return read_scored(spark, target)

    batch, refused = score_batch(wanted, scorer)
    scored, rejected = run()
    assert scored.exceptAll(batch).count() == 0
    assert rejected.select("claim_id", FAILED).exceptAll(refused.select("claim_id", FAILED)).count() == 0
    assert (scored.count(), rejected.count()) == (batch.count(), refused.count())
    assert rejected.count() > 0
    # nothing new has arrived
    assert run()[0].count() == batch.count()


def test_serving_writes_scores_refusals_and_logs(spark, data, scorer, tmp_path):
    wanted = requests_of(data[0]).withColumn("description", F.lit("Burst pipe in the bathroom flooded the hallway."))
    wanted = wanted.withColumn("product", F.when(F.col("customer_age") == 30, "pet").otherwise(F.col("product")))
    target = str(tmp_path / "served")
    rows = serve_triage(spark, wanted, scorer, target)
    refused = wanted.filter("product = 'pet'").count()
    assert rows.count() == 3000 - refused
    assert [tuple(r) for r in rows.select("damage_type", "urgency").distinct().collect()] == [("water", "high")]
    served = serve_batch(spark, wanted, scorer, target)
    assert (served.scored_rows, served.rejected_rows) == (3000 - refused, refused)
    log = [json.loads(r.value) for r in spark.read.text(f"{target}/prediction_log").collect()]
    assert len(log) == 2 * (3000 - refused)
    assert {r["batch_size"] for r in log} == {3000 - refused}
    assert spark.read.text(f"{target}/extraction_log").count() == 3000 - refused
    # a run that is repeated by its name replaces its records
    for _ in range(2):
        serve_batch(spark, wanted, scorer, target, run="nightly")
    assert spark.read.text(f"{target}/prediction_log").count() == 3 * (3000 - refused)

    def broken(texts):
        raise ValueError("the reader is away")

    rows = serve_triage(spark, wanted, scorer, str(tmp_path / "broken"), broken)
    assert rows.filter("needs_manual_review AND fraud_score IS NOT NULL").count() == 3000 - refused
    # a claim sent three times gets three scores, not nine
    thrice = wanted.filter("claim_id = 'C000007'")
    thrice = thrice.union(thrice).union(thrice.withColumn("description", F.lit("Stolen phone.")))
    assert serve_triage(spark, thrice, scorer, str(tmp_path / "thrice")).count() == 3


def test_models_by_uri(registry):
    assert registry[0].load_uri("models:/m@champion").model_type == registry[2]
    with pytest.raises(ValueError, match="models:/"):
        registry[0].load_uri("m")


def test_training_command_line(data, tmp_path, capsys):
    data[1].write.parquet(str(tmp_path / "features"))
    options = ["--features-path", str(tmp_path / "features"), "--registry", str(tmp_path / "r"), "--max-iter", "3"]
    assert training_main(options) == 0
    printed = json.loads(capsys.readouterr().out)
    assert printed["version"] == 1
    assert printed["champion"] in printed["metrics"]


RULES = (Rule("value_present", "value IS NOT NULL"), Rule("value_positive", "value IS NULL OR value > 0"))


def test_stream_quality_equals_batch(spark, small, tmp_path):
    defects = (Defect("empty", "value", F.lit(None), 0.02), Defect("negative", "value", -F.col("value"), 0.02))
    events = spark.read.parquet(f"{small}/events.parquet")
    dirty = inject(events, defects, "event_id")
    arriving, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    # copies of an event arrive in different files
    inject_duplicates(dirty, "event_id", 0.2).repartition(4).write.parquet(arriving)

    def run():
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
        stream_quality(stream, RULES, ["event_id"], "ts", target, offsets).awaitTermination()
        return read_checked(spark, target)

    good, bad = run()
    expected_good, expected_bad = split_valid(apply_rules(dirty, RULES))
    keep = ["event_id", "value"]
    assert good.select(keep).exceptAll(expected_good.select(keep)).count() == 0
    assert good.count() == expected_good.count()
    assert bad.select("event_id", FAILED).exceptAll(expected_bad.select("event_id", FAILED)).count() == 0
    assert bad.count() == expected_bad.count() > 0
    assert good.select("ts").schema[0].dataType.typeName() == "timestamp"
    # nothing new has arrived
    again, _ = run()
    assert again.count() == good.count()


def test_late_events_are_kept(spark, tmp_path):
    arriving, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    ddl = "event_id long, ts timestamp_ntz, value double"

    def arrive(*rows):
        values = ", ".join(f"({i}L, TIMESTAMP_NTZ'{ts}', {v}D)" for i, ts, v in rows)
        spark.sql(f"SELECT * FROM VALUES {values} AS t(event_id, ts, value)").write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(ddl).parquet(arriving)
        stream_quality(stream, RULES, ["event_id"], "ts", target, offsets).awaitTermination()
        good, bad = read_checked(spark, target)
        return sorted(r.event_id for r in good.collect()), sorted(r.event_id for r in bad.collect())

    assert arrive((1, "2024-01-05 10:00:00", 1), (1, "2024-01-05 10:00:00", 1), (2, "2024-01-06 10:00:00", -1)) == ([1], [2])
    # years late, but new; and a copy of an event of the first batch
    assert arrive((3, "2020-01-01 00:00:00", 3), (1, "2024-01-05 10:00:00", 1)) == ([1, 3], [2])
    assert arrive((3, "2020-01-01 00:00:00", 3)) == ([1, 3], [2])


def test_a_new_checkpoint_loses_and_repeats_nothing(spark, tmp_path):
    """A second query starts at batch 0 on a target that has rows; events without a time are matched, too."""
    target, ddl = str(tmp_path / "out"), "event_id long, ts timestamp, value double"

    def arrive(name, *rows):
        arriving = str(tmp_path / f"in-{name}")
        values = ", ".join(f"({i}L, CAST({ts} AS TIMESTAMP), {v}D)" for i, ts, v in rows)
        spark.sql(f"SELECT * FROM VALUES {values} AS t(event_id, ts, value)").coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(arriving)
        stream_quality(stream, RULES, ["event_id"], "ts", target, str(tmp_path / f"offsets-{name}")).awaitTermination()
        return sorted(r.event_id for r in read_checked(spark, target)[0].collect())

    first = ((1, "NULL", 1), (2, "'2024-01-05'", 1), (3, "'2024-01-06'", 1))
    assert arrive("a", *first) == [1, 2, 3]
    assert arrive("a", (1, "NULL", 1), (4, "NULL", 1)) == [1, 2, 3, 4]
    assert arrive("b", *first, (9, "'2024-01-05'", 1)) == [1, 2, 3, 4, 9]


def test_run_all_stops_at_the_gate_and_otherwise_registers(spark, small, tmp_path):
    lake = Snapshots(spark, str(tmp_path / "lake"))
    store = ModelRegistry(spark, str(tmp_path / "registry"))
    feeds = raw_feeds(spark, small)
    with pytest.raises(RuntimeError, match="Quality gate"):
        run_all(spark, lake, feeds, store, limit=0.001)
    assert store.runs().count() == 0
    outcome, best, version = run_all(spark, lake, feeds, store, limit=0.05, params=QUICK)
    assert outcome.ledgers["claims"].valid_rows > 0
    assert (store.load("claim-review").model_type, version) == (best, 1)


def test_stream_ledger_and_gate(spark, tmp_path):
    """Ledgers of micro-batches add up to the batch report; a batch over the limit is reported but not written."""
    arriving, target, offsets, report = (str(tmp_path / n) for n in ("in", "out", "offsets", "report"))
    ddl = "event_id long, ts timestamp_ntz, value double"

    def arrive(limit, *rows):
        if rows:
            values = ", ".join(f"({i}L, TIMESTAMP_NTZ'2024-01-05 10:00:00', {v}D)" for i, v in rows)
            spark.sql(f"SELECT * FROM VALUES {values} AS t(event_id, ts, value)").coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(ddl).parquet(arriving)
        query = stream_quality(stream, RULES, ["event_id"], "ts", target, offsets, report=report, limit=limit)
        query.awaitTermination()

    def reported():
        columns = ("dataset", "rule", "failed_rows", "total_rows", "quarantined_rows", "duplicates_removed", "quarantine_rate")
        return {r["rule"]: tuple(r)[2:] for r in read_report(spark, report).select(*columns).collect()}

    arrive(0.5, (1, 1), (2, -1), (2, -1))
    # a copy of a stored event
    arrive(0.5, (3, 1), (1, 1))
    assert set(reported().values()) == {(1, 3, 1, 2, 0.3333), (0, 3, 1, 2, 0.3333)}
    before = sorted(r["event_id"] for r in read_checked(spark, target)[0].collect())
    with pytest.raises(StreamingQueryException, match="Quality gate failed for events: 2 of 3"):
        arrive(0.5, (4, -1), (5, -1), (6, 1))
    assert sorted(r["event_id"] for r in read_checked(spark, target)[0].collect()) == before == [1, 3]
    assert {v[1] for v in reported().values()} == {6}
    # the same micro-batch again, under a looser limit: counted once
    arrive(1.0)
    assert sorted(r["event_id"] for r in read_checked(spark, target)[0].collect()) == [1, 3, 6]
    assert {v[1:4] for v in reported().values()} == {(6, 3, 2)}
    with pytest.raises(ValueError, match="needs a folder"):
        stream_quality(spark.readStream.schema(ddl).parquet(arriving), RULES, ["event_id"], "ts", target, offsets, limit=0.5)


def test_a_micro_batch_writes_few_files_a_day(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "FILE_ROWS", 100)
    hour = F.timestamp_seconds(F.lit(1704067200) + F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 3 * 86400))
    events = spark.range(600).select(F.col("id").alias("event_id"), hour.alias("ts"), F.lit(1.0).alias("value"))
    arriving, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    events.coalesce(1).write.parquet(arriving)
    stream_quality(spark.readStream.schema(events.schema).parquet(arriving), RULES, ["event_id"], "ts", target, offsets).awaitTermination()
    files = spark.read.parquet(target).select(F.input_file_name().alias("file"), jobs.DAY, "event_id")
    by_day = files.groupBy(jobs.DAY).agg(F.count_distinct("file").alias("n"), F.count_distinct("event_id").alias("rows"))
    found = sorted((r["n"], r["rows"]) for r in by_day.collect())
    # the small days in one file each, the large one in at most its parts
    assert [n for n, _ in found[:2]] == [1, 1] and found[-1][0] <= 5
    assert sum(rows for _, rows in found) == 600 and found[-1][1] > 400


def test_requests_are_read_once(spark, data, scorer, tmp_path):
    wanted, seen = requests_of(data[0]), spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = wanted.count()
    served = serve_batch(spark, wanted.mapInPandas(counted, wanted.schema), scorer, str(tmp_path / "once"))
    assert served.scored_rows + served.rejected_rows == rows == seen.value
