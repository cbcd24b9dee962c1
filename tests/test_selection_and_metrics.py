from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trustlake.operators.bounded import few_rows
from trustlake.operators.metrics import confusion, evaluate, flag_metrics, ranking_metrics, review_threshold, running_counts
from trustlake.operators import selection
from trustlake.operators.selection import group_quantile, hash_split, stratified_split


def grouped_values(spark, seed):
    """Several groups, one of them named NULL, one with a value that fills a third of it, one tiny, one all NULL."""
    rng = np.random.default_rng(seed)
    rows = []
    for name, size in (("a", 900), ("b", 401), (None, 300), ("tiny", 2), ("one", 1)):
        values = np.round(rng.lognormal(3, 2, size), 2)
        if name == "b":
            values[: size // 3] = 7.5
        rows += [(name, float(v)) for v in values]
    rows += [("a", None), ("empty", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5), rows


@contextmanager
def in_ranges(spark, n):
    """So many ranges, none of them joined again."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("ranges", [1, 4, 23])
def test_group_quantile_is_exact(spark, q, ranges):
    frame, rows = grouped_values(spark, 5)
    with in_ranges(spark, ranges):
        found = {r.g: r.m for r in group_quantile(frame, ["g"], "v", q, "m").collect()}
    expected = {}
    for name in {g for g, v in rows if v is not None}:
        expected[name] = float(np.quantile([v for g, v in rows if g == name and v is not None], q))
    assert found.keys() == expected.keys()
    for name, value in expected.items():
        assert found[name] == pytest.approx(value, rel=1e-12)


def test_quantile_of_a_whole_table(spark):
    frame = spark.range(100_000).select((F.col("id") * 7919 % 100_003).cast("double").alias("v"))
    values = (np.arange(100_000) * 7919) % 100_003
    found = group_quantile(frame, [], "v", 0.95, "m").first().m
    assert found == pytest.approx(float(np.quantile(values, 0.95)), rel=1e-12)


def test_one_value_everywhere(spark):
    frame = spark.range(5000).select(F.lit(3.0).alias("v"))
    assert group_quantile(frame, [], "v", 0.5, "m").first().m == 3.0


@pytest.mark.parametrize("ranges", [1, 5])
def test_quantiles_with_numbers_that_are_none(spark, ranges):
    """NaN counts as the largest value, infinities as they are, however the rows are dealt."""
    inf, nan = float("inf"), float("nan")
    rows = [("a", v) for v in (1.0, 2.0, 3.0, nan, inf)] + [("b", v) for v in (-inf, 0.0, 1.0)] + [("c", nan)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(3)
    with in_ranges(spark, ranges):
        found = {r.g: r.m for r in group_quantile(frame, ["g"], "v", 0.5, "m").collect()}
        low = {r.g: r.m for r in group_quantile(frame, ["g"], "v", 0.0, "m").collect()}
    assert (found["a"], found["b"]) == (3.0, 0.0) and np.isnan(found["c"])
    assert (low["a"], low["b"]) == (1.0, -inf)


def rows_stored(monkeypatch):
    """The sizes of all frames that selections store from now on."""
    sizes = []

    def cut(frame, store=selection.lineage_cut):
        stored = store(frame)
        sizes.append(stored.count())
        return stored

    monkeypatch.setattr(selection, "lineage_cut", cut)
    return sizes


def test_quantile_orders_only_values_near_it(spark, monkeypatch):
    frame = spark.range(50_000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 100_003 + 0.25).alias("v"))
    rows = [(i % 2, i * 7919 % 100_003 + 0.25) for i in range(50_000)]
    sizes = rows_stored(monkeypatch)
    found = {r.g: r.m for r in group_quantile(frame, ["g"], "v", 0.5, "m").collect()}
    assert found == {g: pytest.approx(float(np.median([v for h, v in rows if h == g]))) for g in (0, 1)}
    assert max(sizes) < 1000


@pytest.mark.parametrize("q", [0.0, 0.1, 0.35, 0.5, 0.77, 1.0])
def test_quantile_of_values_of_every_size(spark, q):
    """Values that share a bucket, that lie buckets apart, and both signs of nothing."""
    sizes = [1e-300, 1e-12, 1.0, 1.0 + 1e-13, 1.0 + 2e-13, 7.0, 1e15, 1e15 + 1, 1e300]
    values = [s * v for v in sizes for s in (1, -1)] + [0.0, -0.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    assert group_quantile(frame, [], "v", q, "m").first().m == pytest.approx(float(np.quantile(values, q)), rel=1e-9, abs=1e-310)


def test_split_orders_only_hashes_near_the_cut(spark, monkeypatch):
    rows = spark.range(20_000).select("id", (F.col("id") % 3).alias("y"))
    sizes = rows_stored(monkeypatch)
    split = stratified_split(rows, "y", "id")
    counts = {(r.y, r.is_test): r["count"] for r in split.groupBy("y", "is_test").count().collect()}
    assert counts == {(0, True): 1334, (0, False): 5333, (1, True): 1334, (1, False): 5333, (2, True): 1334, (2, False): 5332}
    assert max(sizes) <= 3


def test_empty_table_has_no_quantile(spark):
    frame = spark.range(0).select(F.lit("a").alias("g"), F.lit(1.0).alias("v"))
    assert group_quantile(frame, ["g"], "v", 0.5, "m").count() == 0


def test_split_is_exact_per_label_and_ignores_order(spark):
    rows = spark.range(1013).select(F.col("id"), F.when(F.col("id") % 30 == 0, 1).otherwise(0).alias("y"))
    first = stratified_split(rows, "y", "id")
    second = stratified_split(rows.repartition(9).orderBy(F.desc("id")), "y", "id")
    assert first.exceptAll(second).count() == 0
    counts = {(r.y, r.is_test): r["count"] for r in first.groupBy("y", "is_test").count().collect()}
    # ceil(0.2 * 34) and ceil(0.2 * 979)
    assert counts == {(1, True): 7, (1, False): 27, (0, True): 196, (0, False): 783}
    other = stratified_split(rows, "y", "id", seed=7)
    assert first.exceptAll(other).count() > 0


def test_split_keeps_copies_of_a_key_together_and_null_labels(spark):
    rows = spark.range(900).select((F.col("id") % 300).alias("id"), F.lit(None).cast("int").alias("y"))
    split = stratified_split(rows, "y", "id")
    assert split.count() == 900
    assert split.groupBy("id").agg(F.count_distinct("is_test").alias("n")).filter("n > 1").count() == 0
    assert split.filter("is_test").count() == pytest.approx(180, abs=2)


def test_narrow_split(spark):
    split = hash_split(spark.range(10_000), "id", 0.2)
    assert split.filter("is_test").count() == pytest.approx(2000, abs=150)
    assert "Exchange" not in plan_of(split)


def test_few_rows(spark):
    frame = few_rows(spark, [("a", 1, [("x", 1.0)])], "s string, n long, m map<string,double>")
    assert frame.first().asDict() == {"s": "a", "n": 1, "m": {"x": 1.0}}
    assert few_rows(spark, [], "s string").count() == 0


def brute_force(pairs):
    """Both ranking metrics from all pairs and all thresholds."""
    pos, neg = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    precision_sum, before = 0.0, 0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        tp = sum(p >= t for p in pos)
        flagged = tp + sum(n >= t for n in neg)
        precision_sum += (tp - before) / len(pos) * tp / flagged
        before = tp
    return auc, precision_sum


@pytest.mark.parametrize("ranges", [1, 7, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_ranking_metrics_against_brute_force(spark, seed, ranges):
    rng = np.random.default_rng(seed)
    pairs = [(float(np.round(rng.normal(), 1)), int(rng.random() < 0.3)) for _ in range(400)]
    pairs += [(0.3, int(i % 4 == 0)) for i in range(200)]
    # rows without a score that can be ranked do not count
    unknown = [(float("nan"), 1), (None, 1), (0.5, None)]
    frame = spark.createDataFrame(pairs + unknown, "s double, y int").repartition(4)
    with in_ranges(spark, ranges):
        row = ranking_metrics(frame, "s", "y").first()
    auc, ap = brute_force(pairs)
    assert row.roc_auc == pytest.approx(auc, rel=1e-12)
    assert row.average_precision == pytest.approx(ap, rel=1e-12)


def test_perfect_inverted_and_constant_rankings(spark):
    frame = spark.range(100).select((F.col("id") >= 80).cast("int").alias("y"), "id", F.lit(0.5).alias("same"))
    assert tuple(ranking_metrics(frame, "id", "y").first()) == (1.0, 1.0)
    assert ranking_metrics(frame.withColumn("id", -F.col("id")), "id", "y").first().roc_auc == 0.0
    assert tuple(ranking_metrics(frame, "same", "y").first()) == (0.5, pytest.approx(0.2))


def test_metrics_of_nothing_are_missing(spark):
    frame = spark.range(0).select(F.col("id").alias("s"), F.lit(1).alias("y"))
    assert tuple(ranking_metrics(frame, "s", "y").first()) == (None, None)


def test_running_counts_span_ranges(spark):
    frame = spark.range(50).select((F.col("id") % 2).cast("int").alias("y"), "id")
    with in_ranges(spark, 9):
        rows = running_counts(frame, "id", "y").orderBy("score").collect()
    assert [r.pos_below + r.neg_below for r in rows] == list(range(50))
    assert {(r.positives, r.negatives) for r in rows} == {(25, 25)}


def test_confusion_has_all_four_cells(spark):
    frame = spark.createDataFrame([(0, False), (0, False), (1, True)], "y int, f boolean")
    cells = {(r.label, r.flagged): r["rows"] for r in confusion(frame, "f", "y").collect()}
    assert cells == {(0, False): 2, (0, True): 0, (1, False): 0, (1, True): 1}


def test_flag_metrics_without_flags(spark):
    frame = spark.createDataFrame([(0, False), (1, False), (1, None), (None, True)], "y int, f boolean")
    assert tuple(flag_metrics(frame, "f", "y").first()) == (0.0, 0.0, 0.0, 0.5, 0.5)


def test_evaluate_and_threshold(spark):
    frame = spark.range(1000).select((F.col("id") / 1000).alias("s"), (F.col("id") % 100 == 99).cast("int").alias("y"))
    threshold = review_threshold(frame, "s", 0.1)
    assert frame.filter(F.col("s") >= threshold).count() == pytest.approx(100, abs=1)
    row = evaluate(frame, "s", "y", threshold).first()
    assert (row.flagged_rate, row.recall, row.precision, row.accuracy_if_never_fraud) == (0.1, 0.1, 0.01, 0.99)


def test_a_split_does_not_deal_rows_by_label(spark):
    """With two labels, most rows would meet in one task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        rows = spark.range(3000).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
        split = stratified_split(rows, "label", "id")
        assert "BroadcastHashJoin" in plan_of(split) and "SortMergeJoin" not in plan_of(split)
        assert sorted(map(tuple, split.filter("is_test").groupBy("label").count().collect())) == [(0, 540), (1, 60)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
