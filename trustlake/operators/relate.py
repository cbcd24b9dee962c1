"""Checks that relate two tables: existence, orphans, reconciliation, conservation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.operators.bounded import side_by_side
from trustlake.operators.rules import is_valid

#: Rows of both sides that one task of ``joined_by_key`` joins.
TASK_ROWS = 500_000


def mark_existing(df: DataFrame, known: DataFrame, on: str, flag: str) -> DataFrame:
    """Keep every row and add whether its key occurs in ``known`` (whose keys must be unique).

    No join hint: Catalyst broadcasts the key list only where its size allows, and AQE splits a hot key of the large
    side in the sort-merge join it uses otherwise.
    """
    marked = known.select(on).withColumn(flag, F.lit(True))
    return df.join(marked, on, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def joined_by_key(left: DataFrame, left_key: str, right: DataFrame, right_key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Inner join of two large tables whose parts have about ``task_rows`` rows of both, whatever the size of the tables.

    Sorts of the join, and aggregates by the key after it, are held once per part, so their memory does not grow. The rows
    are counted first, which for stored tables reads no column.
    """
    parts = max(1, -(-(left.count() + right.count()) // task_rows))
    condition = F.col(left_key) == F.col(right_key)
    return left.repartition(parts, left_key).join(right.repartition(parts, right_key), condition)


def orphans(df: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Rows whose key does not occur in ``known``; a missing key is an orphan too."""
    return df.join(known.select(on), on, "left_anti")


def reconcile(left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Compare two versions of a table key by key; one row per column with the number of keys that differ.

    Both sides go through one grouped aggregate instead of an outer join. Repeated keys are folded on the map side (the
    smallest row of each side is compared), so no key can blow up into all pairs of its copies; ``copies_left`` and
    ``copies_right`` say how many rows were folded away.
    """
    key, columns = list(key), list(columns)
    sides = []
    for name, frame in (("l", left), ("r", right)):
        row = F.struct(*columns)
        sides.append(
            frame.select(
                *key,
                (row if name == "l" else F.lit(None)).alias("_l"),
                (row if name == "r" else F.lit(None)).alias("_r"),
            )
        )
    paired = (
        sides[0]
        .union(sides[1])
        .groupBy(*key)
        .agg(F.min("_l").alias("_l"), F.min("_r").alias("_r"), F.count("_l").alias("_nl"), F.count("_r").alias("_nr"))
    )
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    counts = paired.agg(
        F.count_if(F.col("_r").isNull()).alias("only_left"),
        F.count_if(F.col("_l").isNull()).alias("only_right"),
        F.count_if(both).alias("compared"),
        F.coalesce(F.sum(F.greatest(F.col("_nl") - 1, F.lit(0))), F.lit(0)).alias("copies_left"),
        F.coalesce(F.sum(F.greatest(F.col("_nr") - 1, F.lit(0))), F.lit(0)).alias("copies_right"),
        *(F.count_if(both & ~F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}"))).alias(f"c:{c}") for c in columns),
    )
    lines = [F.struct(F.lit(c).alias("column"), F.col(f"`c:{c}`").alias("mismatches")) for c in columns]
    return counts.select(F.inline(F.array(*lines)), "compared", "only_left", "only_right", "copies_left", "copies_right")


def conservation(source: DataFrame, key: str, checked: DataFrame) -> DataFrame:
    """Nothing is lost: distinct keys of the source, plus its rows without a key, equal good plus bad rows.

    One row with both sides of the equation. Rows without a key are no copies of each other, so each counts.
    """
    keys = source.agg(
        F.count_distinct(key).alias("distinct_keys"), F.count_if(F.col(key).isNull()).alias("keyless_rows")
    )
    outcomes = checked.agg(
        F.count_if(is_valid()).alias("valid_rows"), F.count_if(~is_valid()).alias("quarantined_rows")
    )
    both = side_by_side(keys, outcomes)
    kept = F.col("valid_rows") + F.col("quarantined_rows")
    return both.withColumn("conserved", F.col("distinct_keys") + F.col("keyless_rows") == kept)
