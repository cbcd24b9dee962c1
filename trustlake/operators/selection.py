"""Exact order statistics and prefix sums without putting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustlake.functions.hashing import chosen, keyed_hash
from trustlake.session import lineage_cut

RANGE = "_range"
#: Buckets of ``group_quantile`` for values that differ by a factor of e; results do not depend on it.
BUCKETS = 512
#: Digits by which ``stratified_split`` counts hashes; results do not depend on it.
BUCKET_DIGITS = 4


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a missing name is a name of its own; the keys come from the left side."""
    renamed = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    condition = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on))
    return left.join(renamed, condition, how).drop(*(f"_on_{c}" for c in on))


def prefix_sums(df: DataFrame, groups: Sequence[str], order: str, sums: Sequence[str]) -> DataFrame:
    """Add, per column of ``sums``, ``<column>_before`` (the group's sum over smaller ``order``) and ``<column>_total``.

    ``order`` must be unique within a group. The rows are dealt into ranges of (groups, order), however large a group is;
    a window runs inside each range, and the ranges before it contribute their totals. The only rows that a group gathers
    are one total per range.
    """
    groups = list(groups)
    ranged = lineage_cut(df.repartitionByRange(*groups, order).withColumn(RANGE, F.spark_partition_id()))
    totals = ranged.groupBy(*groups, RANGE).agg(*(F.sum(c).alias(c) for c in sums))
    group = Window.partitionBy(*groups)
    before = group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *groups,
        RANGE,
        *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_offset") for c in sums),
        *(F.sum(c).over(group).alias(f"{c}_total") for c in sums),
    )
    inside = Window.partitionBy(RANGE, *groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # stored, so that the join knows how small they are and leaves the ranges where the window has put them
    placed = null_safe_join(
        ranged.withColumns({f"{c}_inside": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums}),
        lineage_cut(offsets),
        [*groups, RANGE],
    )
    return placed.select(
        *df.columns,
        *((F.col(f"{c}_offset") + F.col(f"{c}_inside")).alias(f"{c}_before") for c in sums),
        *(f"{c}_total" for c in sums),
    )


def value_bucket(value: Column) -> Column:
    """A whole number that never falls as the value grows: about one step for every 1/``BUCKETS`` of its size. NaN comes last."""
    step = F.signum(value) * F.rint(F.log1p(F.abs(value)) * F.lit(float(BUCKETS)))
    return F.when(F.isnan(value), F.lit(2**63 - 1)).otherwise(F.floor(step))


def with_running_counts(tallies: DataFrame, groups: Sequence[str], order: str, n: str) -> DataFrame:
    """Add ``_below`` (the group's ``n`` at smaller ``order``) and ``_all`` (its total), for groups of a bounded number of rows."""
    group = Window.partitionBy(*groups)
    before = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return tallies.select(
        "*", F.coalesce(F.sum(n).over(before), F.lit(0)).alias("_below"), F.sum(n).over(group).alias("_all")
    )


def group_quantile(df: DataFrame, groups: Sequence[str], value: str, q: float, out: str) -> DataFrame:
    """(groups, out): the linearly interpolated quantile of the non-null values of every group, exactly.

    NaN counts as larger than any number. Values are first counted by bucket, on the map side; only those of the buckets that hold
    the wanted ranks, two a group at most, are shuffled, as counts of equal values, and ordered. ``df`` is read twice.
    """
    groups = list(groups)
    known = df.select(*groups, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    known = known.withColumn("_k", value_bucket(F.col("_v")))
    position = F.lit(float(q)) * (F.col("_all") - 1)

    def covers(rank, before, n):
        return (before <= rank) & (rank < before + n)

    # the number of buckets is bounded, so those of a group may meet
    buckets = with_running_counts(known.groupBy(*groups, "_k").agg(F.count(F.lit(1)).alias("_n")), groups, "_k", "_n")
    wanted = [covers(rank, F.col("_below"), F.col("_n")) for rank in (F.floor(position), F.ceil(position))]
    # stored, so that the join knows how small they are
    cut = lineage_cut(buckets.filter(wanted[0] | wanted[1]).select(*groups, "_k", "_below", "_all"))
    inside = null_safe_join(known, cut, [*groups, "_k"])
    counted = inside.groupBy(*groups, "_k", "_below", "_all", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = prefix_sums(counted, [*groups, "_k"], "_v", ["_c"]).withColumn("_pos", position)

    def value_at(rank):
        return F.max(F.when(covers(rank, F.col("_below") + F.col("_c_before"), F.col("_c")), F.col("_v")))

    lower, upper = value_at(F.floor("_pos")), value_at(F.ceil("_pos"))
    share = F.max(F.col("_pos") - F.floor("_pos"))
    ends = ranked.groupBy(*groups).agg(lower.alias("_l"), upper.alias("_u"), share.alias("_s"))
    mixed = (1 - F.col("_s")) * F.col("_l") + F.col("_s") * F.col("_u")
    # a share of nothing takes nothing, not even of an infinite neighbour
    return ends.select(*groups, F.when(F.col("_s") == 0, F.col("_l")).otherwise(mixed).alias(out))


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_size: float = 0.2,
    seed: object = 42,
    out: str = "is_test",
) -> DataFrame:
    """Mark, per label, ``ceil(test_size * rows)`` rows as test rows: those whose keyed hash is smallest.

    The result depends only on which keys there are. Rows with equal keys, or without one, share a hash and stay together.
    Hashes are counted by their first digits, on the map side; only those that begin like the last test row's are ordered, one in
    65,536 of a label's keys. ``df`` is read three times.
    """
    hashed = df.withColumn("_hash", keyed_hash(seed, key))
    begun = hashed.select(F.col(label).alias("_label"), F.substring("_hash", 1, BUCKET_DIGITS).alias("_bucket"), "_hash")
    tallies = with_running_counts(begun.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n")), ["_label"], "_bucket", "_n")
    need = F.ceil(F.round(F.col("_all") * F.lit(float(test_size)), 6))
    # the cut lies in one bucket per label
    last = tallies.filter((F.col("_below") < need) & (F.col("_below") + F.col("_n") >= need))
    last = lineage_cut(last.select("_label", "_bucket", (need - F.col("_below")).alias("_need")))
    hashes = null_safe_join(begun, last, ["_label", "_bucket"]).groupBy("_label", "_need", "_hash").agg(F.count(F.lit(1)).alias("_n"))
    placed = with_running_counts(hashes, ["_label"], "_hash", "_n")
    placed = placed.filter((F.col("_below") < F.col("_need")) & (F.col("_below") + F.col("_n") >= F.col("_need")))
    # stored, so that the join knows how small they are: dealt by label, all rows of a label would meet in one task
    cuts = lineage_cut(placed.groupBy("_label").agg(F.min("_hash").alias("_cut")))
    joined = null_safe_join(hashed.withColumn("_label", F.col(label)), cuts, ["_label"], "left")
    inside = F.coalesce(F.col("_hash") <= F.col("_cut"), F.lit(False))
    return joined.select(*df.columns, inside.alias(out))


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, seed: object = 42, out: str = "is_test") -> DataFrame:
    """The narrow variant: about ``test_size`` of the keys, decided row by row without any shuffle."""
    return df.withColumn(out, chosen(seed, test_size, key))
