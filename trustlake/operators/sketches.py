"""Stored sketches by group and day, merged for any range of days without reading rows again.

For dashboards over long ranges. Where a number decides something, the exact operators of ``selection`` and ``metrics``
stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALUES, IDENTS = "value_sketch", "ident_sketch"
#: Size of a quantile sketch; a rank is off by about 2.3 / k ** 0.9 at most, with 99 % confidence.
SKETCH_K = 800
#: Binary logarithm of a counting sketch's size; a count is off by about 1.04 / sqrt(2 ** lg) on average.
SKETCH_LG = 12


def daily_sketches(
    rows: DataFrame, group: Sequence[str], day: str, value: str, ident: str, k: int = SKETCH_K, lg: int = SKETCH_LG
) -> DataFrame:
    """By group and day: number of rows and of values, a sketch of the values, a sketch of the distinct identifiers.

    Null and NaN are no values. A day without a value has a null sketch, which merging skips. Each map task folds its rows
    into sketches, so what is shuffled are sketches, however many rows a group has.
    """
    number = F.col(value).cast("double")
    known = F.when(~F.isnan(number), number)
    return rows.groupBy(*group, F.to_date(day).alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(known).alias("n_values"),
        F.when(F.count(known) > 0, F.kll_sketch_agg_double(known, F.lit(k))).alias(VALUES),
        F.hll_sketch_agg(F.col(ident), F.lit(lg)).alias(IDENTS),
    )


def over_days(sketches: DataFrame, group: Sequence[str], first: str, last: str) -> DataFrame:
    """One merged state per group of the days from ``first`` to ``last``, both included."""
    days = sketches.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    # no sketch is left where no day has a value
    return days.groupBy(*group).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.when(F.sum("n_values") > 0, F.kll_merge_agg_double(VALUES)).alias(VALUES),
        F.hll_union_agg(IDENTS).alias(IDENTS),
    )


def sketched_quantiles(states: DataFrame, group: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """``probability, value`` per group: a value whose rank is within the sketch's bound of the probability."""
    asked = F.array(*(F.lit(float(p)) for p in probabilities))
    found = states.select(*group, F.kll_sketch_get_quantile_double(VALUES, asked).alias("_found"), F.posexplode(asked))
    return found.select(*group, F.col("col").alias("probability"), F.get("_found", F.col("pos")).alias("value"))


def sketched_distinct(states: DataFrame, group: Sequence[str]) -> DataFrame:
    """About how many distinct identifiers each group has."""
    return states.select(*group, F.hll_sketch_estimate(IDENTS).alias("idents"))
