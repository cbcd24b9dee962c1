"""Digests must find exactly what a comparison of all rows finds, and move only what differs."""

import random

import pytest
from pyspark.sql import functions as F

from trustlake.operators import digest_tree
from trustlake.operators.digest_tree import differing_leaves, digest_leaves, leaf_bits, reconcile_by_digest, roll_up, rows_of_leaves
from trustlake.operators.relate import reconcile

SCHEMA = "k long, a string, b double"


def both_ways(left, right, unique=False):
    plain = reconcile(left, right, ["k"], ["a", "b"]).collect()
    return sorted(plain), sorted(reconcile_by_digest(left, right, ["k"], ["a", "b"], unique).collect())


@pytest.mark.parametrize("seed", range(3))
def test_same_as_all_rows(spark, seed):
    dice = random.Random(seed)
    rows = [(dice.choice([None, *range(400)]), dice.choice("xyz"), dice.choice([None, 0.0, 1.5])) for _ in range(500)]
    other = [(k, a, 2.0 if dice.random() < 0.05 else b) for k, a, b in rows if dice.random() > 0.02]
    plain, by_digest = both_ways(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA))
    assert plain == by_digest


def test_equal_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "x", 1.0), (1, "x", 1.0), (None, None, None), (2, "y", None)], SCHEMA)
    none = rows.limit(0)
    for left, right in ((rows, rows.repartition(3)), (rows, none), (none, rows), (none, none)):
        plain, by_digest = both_ways(left, right)
        assert plain == by_digest


def test_missing_values_and_copies_are_told_apart(spark):
    """Sums of copies do not cancel, and a missing value counts where it is."""
    pairs = [
        ([(1, None, None), (2, "x", 1.0)], [(2, None, None), (1, "x", 1.0)]),
        ([(1, "x", 1.0)] * 2, [(1, "x", 1.0)] * 4),
        ([(1, "x", 1.0)] * 2, [(1, "y", 1.0)] * 2),
    ]
    for one, other in pairs:
        trees = [digest_leaves(spark.createDataFrame(r, SCHEMA), ["k"], ["a", "b"], 4) for r in (one, other)]
        assert differing_leaves(*trees, 4).count() > 0


def test_one_side_with_unique_keys_is_enough(spark):
    right = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.lit(1.0).alias("b"))
    left = right.unionByName(right.filter("k % 50 = 0"))
    plain, by_digest = both_ways(left, right, unique=True)
    assert plain == by_digest


def test_only_leaves_that_differ_are_compared(spark):
    left = spark.range(40_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("a"), F.lit(1.0).alias("b"))
    right = left.withColumn("a", F.when(F.col("k").isin(7, 21_000), F.lit("changed")).otherwise(F.col("a")))
    bits = leaf_bits(40_000)
    assert bits == 12
    trees = [digest_leaves(f, ["k"], ["a", "b"], bits, unique=True) for f in (left, right)]
    leaves = differing_leaves(*trees, bits)
    assert 1 <= leaves.count() <= 2
    moved = rows_of_leaves(left, ["k"], leaves, bits)
    assert {7, 21_000} <= {r["k"] for r in moved.collect()}
    assert moved.count() < 8 * digest_tree.LEAF_ROWS
    assert both_ways(left, right, unique=True)[1] == both_ways(left, right)[0]


def test_upper_nodes_add_up(spark):
    leaves = digest_leaves(spark.range(3000).withColumn("a", F.lit("x")), ["id"], ["a"], 8)
    assert sorted(roll_up(leaves).collect()) == sorted(digest_leaves(spark.range(3000).withColumn("a", F.lit("x")), ["id"], ["a"], 4).collect())


def test_refuses_other_types_and_repeated_columns(spark):
    rows = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    with pytest.raises(ValueError, match="types"):
        reconcile_by_digest(rows, rows.withColumn("a", F.lit(1)), ["k"], ["a"])
    with pytest.raises(ValueError, match="twice"):
        reconcile_by_digest(rows, rows, ["k"], ["k"])
