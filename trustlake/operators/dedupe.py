"""One row per business key, the same one on every run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES = "_copies"


def dedupe(df: DataFrame, key: Sequence[str], order: Sequence[str] = (), copies: str | None = None) -> DataFrame:
    """Keep, per key, the row that is largest by ``order`` and then by every other column.

    An aggregate rather than a ranked window: copies are folded on the map side, so a key that holds a large part of
    the table never travels to one task row by row.

    Rows without a key are no copies of each other; all are kept. They are grouped by their content and the partition
    they come from, so only equal rows of one partition meet, and are then repeated as often as they occurred. That
    spreads them over all tasks, and a repeated task sends every row to the same place again.

    ``copies`` names a column that receives how many rows were folded into the kept one.
    """
    unknown = sorted(set(key).union(order) - set(df.columns))
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    ranked = [c for c in order if c not in key]
    ranked += [c for c in df.columns if c not in key and c not in ranked]
    keyless = reduce(or_, (F.col(k).isNull() for k in key))

    apart = F.when(keyless, F.struct(F.spark_partition_id(), *ranked))
    # a key-only table still needs something to aggregate
    largest = F.max(F.struct(*ranked) if ranked else F.struct(F.lit(1)))
    kept = (
        df.withColumn("_apart", apart)
        .groupBy(*key, "_apart")
        .agg(largest.alias("_row"), F.count(F.lit(1)).alias(COPIES))
    )
    times = F.when(keyless, F.col(COPIES)).otherwise(F.lit(1).cast("long"))
    folded = F.when(keyless, F.lit(1).cast("long")).otherwise(F.col(COPIES))
    return kept.select(
        *(F.col(c) if c in key else F.col("_row").getField(c).alias(c) for c in df.columns),
        *([folded.alias(copies)] if copies else []),
        F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("_time"),
    ).drop("_time")
