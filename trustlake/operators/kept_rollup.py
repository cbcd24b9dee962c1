"""The monthly roll-up kept up to date: each run adds signed partial states, and no earlier row is aggregated again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trustlake.functions.measures import money, month_of
from trustlake.operators.bounded import few_rows
from trustlake.operators.dedupe import dedupe
from trustlake.operators.gold import TARGET
from trustlake.session import lineage_cut

#: How often a row counts: below zero it is withdrawn.
SIGN = "_sign"
CLAIM_COLUMNS = ("claim_id", "policy_id", "incident_date", "claim_amount", TARGET)
POLICY_COLUMNS = ("policy_id", "product", "region")
GROUP = ("month", "product", "region")
STATE_SCHEMA = (
    "month date, product string, region string, n_claims long, n_amounts long, n_exact long, amount decimal(38,6), "
    "n_labels long, n_frauds long"
)
STATES = ("n_claims", "n_amounts", "n_exact", "amount", "n_labels", "n_frauds")


# --- rows that change --------------------------------------------------------------------------------------------


def superseding(kept: DataFrame, arrived: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """What arrived rows change in kept ones, as signed rows: superseded rows count -1, rows that take their place 1.

    ``kept`` has one row per key. Of a key's kept and arrived rows the one stays that ``dedupe`` keeps, so an arrived row may
    change nothing. Rows without a key supersede none. Kept rows of other keys are neither sorted nor moved.
    """
    fresh = lineage_cut(dedupe(arrived.select(*kept.columns), key, order))
    beside = kept.join(fresh.select(*key), list(key), "left_semi").select(*kept.columns)
    winners = dedupe(beside.unionByName(fresh), key, order)
    both = beside.withColumn(SIGN, F.lit(-1)).unionByName(winners.withColumn(SIGN, F.lit(1)))
    return both.groupBy(*kept.columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)


def applied(kept: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The kept rows after the changes."""
    untouched = kept.join(changes.select(*key).distinct(), list(key), "left_anti").select(*kept.columns)
    added = changes.filter(F.col(SIGN) > 0).withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col(SIGN))))
    return untouched.unionByName(added.select(*kept.columns))


# --- partial states ----------------------------------------------------------------------------------------------


def _joined(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims with their policy's columns; a pair counts as often as the product of its rows' signs."""

    def side(rows: DataFrame, columns: Sequence[str], sign: str) -> DataFrame:
        times = F.col(SIGN) if SIGN in rows.columns else F.lit(1)
        return rows.select(*columns, times.cast("long").alias(sign))

    pairs = side(claims, CLAIM_COLUMNS, "_c").join(side(policies, POLICY_COLUMNS, "_p"), "policy_id")
    return pairs.withColumn(SIGN, F.col("_c") * F.col("_p")).drop("_c", "_p")


def partial_states(records: DataFrame) -> DataFrame:
    """Counts and exact sums by month, product and region of signed records; states of several sets of records add up."""
    amount, label, times = money("claim_amount"), F.col(TARGET), F.col(SIGN)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return records.groupBy(month_of("incident_date").alias("month"), "product", "region").agg(
        total(times).alias("n_claims"),
        total(F.when(F.col("claim_amount").isNotNull(), times)).alias("n_amounts"),
        total(F.when(amount.isNotNull(), times)).alias("n_exact"),
        total(amount * times).cast("decimal(38,6)").alias("amount"),
        total(F.when(label.isNotNull(), times)).alias("n_labels"),
        total(label.cast("long") * times).alias("n_frauds"),
    )


def state_changes(
    claims: DataFrame, claim_changes: DataFrame, policies: DataFrame, policy_changes: DataFrame
) -> DataFrame:
    """What the changes add to the states: changed claims with the policies *after* the changes, and the claims *before*
    them with changed policies only. The second join moves the changed policies to the claims."""
    return partial_states(_joined(claim_changes, policies).unionByName(_joined(claims, policy_changes)))


def merged_states(states: DataFrame) -> DataFrame:
    """One state per group; groups whose claims have all been withdrawn are gone."""
    sums = [F.sum(c).cast("decimal(38,6)" if c == "amount" else "long").alias(c) for c in STATES]
    return states.groupBy(*GROUP).agg(*sums).filter("n_claims != 0")


def monthly_of(states: DataFrame) -> DataFrame:
    """The columns and rows of ``claims_monthly``, from merged states."""
    # as there: a total with an amount that has no decimal is unknown
    total = F.when((F.col("n_amounts") == F.col("n_exact")) & (F.col("n_exact") > 0), F.col("amount"))
    return states.select(
        *GROUP,
        "n_claims",
        F.round(total, 2).cast("double").alias("total_amount"),
        F.round(F.try_divide(total, F.col("n_exact")), 2).cast("double").alias("avg_amount"),
        F.round(F.try_divide(F.col("n_frauds"), F.col("n_labels")), 4).alias("fraud_rate"),
    ).orderBy(*GROUP)


class KeptMonthly:
    """The states that runs have added, a folder for each run; a repeated run overwrites its own.

    A run's states are found before the rows that it changes are replaced, so that repeating it finds the same. A folder
    has at most a row per group that changed; the tables of claims and policies are the caller's.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.folder = spark, f"{base.rstrip('/')}/monthly"
        few_rows(spark, [], STATE_SCHEMA).write.mode("ignore").parquet(f"{self.folder}/run_id=none")

    def add(
        self, run_id: str, claims: DataFrame, claim_changes: DataFrame, policies: DataFrame, policy_changes: DataFrame
    ) -> None:
        """Add a run's changes to the claims and policies that were kept before it."""
        moved = _narrow(policy_changes, POLICY_COLUMNS)
        after = applied(policies.select(*POLICY_COLUMNS), moved, ["policy_id"])
        states = state_changes(claims, _narrow(claim_changes, CLAIM_COLUMNS), after, moved)
        states.write.mode("overwrite").parquet(f"{self.folder}/run_id={run_id}")

    def states(self) -> DataFrame:
        kept = self.spark.read.schema(StructType.fromDDL(f"{STATE_SCHEMA}, run_id string")).parquet(self.folder)
        return merged_states(kept)

    def monthly(self) -> DataFrame:
        return monthly_of(self.states())


def _narrow(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Changes in the columns of the roll-up; changes of other columns cancel out."""
    return changes.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)
