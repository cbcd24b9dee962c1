import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trustlake.operators.dedupe import dedupe
from trustlake.operators.relate import conservation, joined_by_key, mark_existing, orphans, reconcile
from trustlake.operators.rules import Rule, apply_rules


def conflicting(spark):
    """A third of the rows share one key, and all copies differ."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1)
    return spark.range(6000).select(key.alias("k"), (F.col("id") % 7).alias("day"), F.col("id").alias("v"))


def test_winner_does_not_depend_on_partitioning(spark):
    rows = conflicting(spark)
    first = dedupe(rows, ["k"], ["day"], copies="n")
    second = dedupe(rows.repartition(11, "v"), ["k"], ["day"], copies="n")
    assert first.exceptAll(second).count() == second.exceptAll(first).count() == 0
    hot = first.filter("k = 0").first()
    best = rows.filter("k = 0").orderBy(F.desc("day"), F.desc("v")).first()
    assert (hot.day, hot.v, hot.n) == (best.day, best.v, 2000)
    assert first.agg(F.sum("n")).first()[0] == 6000


def test_copies_are_folded_before_the_shuffle(spark):
    plan = plan_of(dedupe(conflicting(spark), ["k"]))
    assert "partial_max" in plan
    assert "Window" not in plan


def test_rows_without_key_are_all_kept(spark):
    values = [(None, 1, 5), (None, 1, 5), ("a", None, 5), ("a", 1, 5), ("a", 1, 5)]
    rows = spark.createDataFrame(values, "x string, y int, z int")
    kept = [tuple(r) for r in dedupe(rows, ["x", "y"], copies="n").collect()]
    assert sorted(kept, key=str) == [("a", 1, 5, 2), ("a", None, 5, 1), (None, 1, 5, 1), (None, 1, 5, 1)]
    assert dedupe(rows.select("x"), ["x"]).count() == 3
    with pytest.raises(ValueError, match="unknown columns"):
        dedupe(rows, ["q"])


def test_existence_and_orphans(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([("a", 1)], "k string, other int")
    marked = {r.k: r.seen for r in mark_existing(rows, known, "k", "seen").collect()}
    assert marked == {"a": True, "b": False, None: False}
    assert sorted(str(r.k) for r in orphans(rows, known, "k").collect()) == ["None", "b"]


def test_reconcile_counts_differences_per_column(spark):
    ddl = "k int, s string, v double"
    left = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0), (4, "d", 4.0)], ddl)
    right = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.5), (5, "e", 5.0)], ddl)
    found = {r["column"]: r.asDict() for r in reconcile(left, right, ["k"], ["s", "v"]).collect()}
    assert (found["s"]["mismatches"], found["v"]["mismatches"]) == (2, 1)
    assert (found["s"]["compared"], found["s"]["only_left"], found["s"]["only_right"]) == (3, 1, 1)
    assert [r.mismatches for r in reconcile(left, left.repartition(3), ["k"], ["s", "v"]).collect()] == [0, 0]


def test_reconcile_does_not_pair_up_copies(spark):
    many = spark.range(5000).select(F.lit(1).alias("k"), F.lit("x").alias("s"))
    plan = plan_of(reconcile(many, many, ["k"], ["s"]))
    assert "Join" not in plan
    row = reconcile(many, many, ["k"], ["s"]).first()
    assert (row.compared, row.copies_left, row.copies_right) == (1, many.count() - 1, many.count() - 1)


def test_conservation(spark):
    rows = spark.range(10).select((F.col("id") % 8).alias("k"))
    checked = apply_rules(dedupe(rows, ["k"]), [Rule("small", "k < 5")])
    assert conservation(rows, "k", checked).first().asDict() == {
        "distinct_keys": 8,
        "keyless_rows": 0,
        "valid_rows": 5,
        "quarantined_rows": 3,
        "conserved": True,
    }
    # rows without a key are kept one by one
    keyless = rows.withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    checked = apply_rules(dedupe(keyless, ["k"]), [Rule("present", "k IS NOT NULL")])
    assert tuple(conservation(keyless, "k", checked).first()) == (7, 2, 7, 2, True)
    assert conservation(keyless, "k", checked.filter("k IS NOT NULL")).first().conserved is False


def test_a_hot_key_is_split_in_the_join(spark):
    """AQE reads the hot partition of the large side in several pieces."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        # a third of the rows share key 0
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
        rows = spark.range(0, 200_000, 1, 8).select(key.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        known = spark.range(5000).select(F.col("id").alias("k"))
        marked = mark_existing(rows, known, "k", "seen")
        assert marked.count() == 200_000
        marked.collect()
        assert "skew=true" in plan_of(marked)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_parts_of_a_join_do_not_grow(spark):
    left = spark.range(300).select((F.col("id") % 100).alias("k"), "id").union(spark.createDataFrame([(None, 1)], "k long, id long"))
    right = spark.range(50).selectExpr("id AS j")
    joined = joined_by_key(left, "k", right, "j", task_rows=10)
    assert "hashpartitioning(k#" in plan_of(joined) and ", 36), REPARTITION_BY_NUM" in plan_of(joined)
    assert sorted(r["id"] for r in joined.collect()) == sorted(i for i in range(300) if i % 100 < 50)
