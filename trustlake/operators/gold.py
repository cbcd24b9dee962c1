"""Reporting roll-ups and the one-row-per-claim feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.functions.measures import days_between, logistic_score, money_avg, money_sum, month_of, ratio
from trustlake.operators.selection import group_quantile, null_safe_join
from trustlake.session import lineage_cut

# The feature columns, in the order in which models expect them.
CATEGORICAL = ("product", "region", "channel")
NUMERIC = (
    "customer_age",
    "claim_amount",
    "annual_premium",
    "days_since_policy_start",
    "report_delay_days",
    "amount_vs_product_median",
    "amount_vs_premium",
)
FEATURES = CATEGORICAL + NUMERIC
TARGET = "is_fraud"
MEDIAN = "product_median"
#: How many unknown products an error names.
NAMED_STRANGERS = 20


# --- roll-ups ----------------------------------------------------------------------------------------------------


def claims_monthly(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Number, cost and fraud rate of claims by month, product and region."""
    dimension = policies.select("policy_id", "product", "region")
    return (
        claims.select("policy_id", "incident_date", "claim_amount", TARGET)
        .join(dimension, "policy_id")
        .groupBy(month_of("incident_date").alias("month"), "product", "region")
        .agg(
            F.count(F.lit(1)).alias("n_claims"),
            money_sum("claim_amount").alias("total_amount"),
            money_avg("claim_amount").alias("avg_amount"),
            F.round(F.avg(TARGET), 4).alias("fraud_rate"),
        )
        .orderBy("month", "product", "region")
    )


def rate_by_group(
    features: DataFrame, group: str = "product", label: str = TARGET, amount: str = "claim_amount"
) -> DataFrame:
    """Rows, positives, percentage of positives and mean amount per group, worst group first."""
    return (
        features.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("claims"),
            F.sum(label).cast("long").alias("fraud_cases"),
            F.round(100 * F.avg(label), 2).alias("fraud_rate_pct"),
            money_avg(amount, 0).alias("avg_amount"),
        )
        .orderBy(F.desc("fraud_rate_pct"), group)
    )


def monthly_rollup(monthly: DataFrame) -> DataFrame:
    """Roll the (month, product, region) table up to months; rates are weighted by their number of claims."""
    weighted = F.sum(F.col("fraud_rate").cast("decimal(9,4)") * F.col("n_claims"))
    return (
        monthly.groupBy("month")
        .agg(
            F.sum("n_claims").alias("claims"),
            money_sum("total_amount", 0).alias("total_cost"),
            F.round(F.try_divide(100 * weighted, F.sum("n_claims")), 2).cast("double").alias("fraud_rate_pct"),
        )
        .orderBy("month")
    )


# --- features ----------------------------------------------------------------------------------------------------


def group_medians(df: DataFrame, group: str = "product", amount: str = "claim_amount") -> DataFrame:
    """(group, product_median): the statistic that training computes and scoring loads."""
    return group_quantile(df, [group], amount, 0.5, MEDIAN)


def with_group_statistic(df: DataFrame, stats: DataFrame, group: str = "product") -> DataFrame:
    """Attach a per-group statistic; rows of a group without one get NULL. No hint: AQE knows the statistics' true size."""
    return null_safe_join(df, stats, [group], "left")


def unknown_groups(df: DataFrame, stats: DataFrame, group: str = "product") -> DataFrame:
    """Distinct groups for which there is no statistic."""
    return df.select(group).distinct().join(stats.select(group), group, "left_anti")


def claim_features(
    records: DataFrame, medians: DataFrame, on_unknown: str = "raise", keep: Sequence[str] = ()
) -> DataFrame:
    """The feature columns of claim records, each of which already carries its policy's columns.

    The same code serves training (``medians`` computed from the data) and scoring (``medians`` loaded with the model).
    ``on_unknown``: ``raise`` refuses products without a median, ``keep`` leaves their ratio NULL.
    """
    if on_unknown == "raise":
        strangers = [row[0] for row in unknown_groups(records, medians).limit(NAMED_STRANGERS + 1).collect()]
        if strangers:
            more = " and others" if len(strangers) > NAMED_STRANGERS else ""
            named = ", ".join(sorted(map(str, strangers[:NAMED_STRANGERS])))
            raise ValueError(f"the model was trained without these products: {named}{more}")
    elif on_unknown != "keep":
        raise ValueError(f"on_unknown must be raise or keep, got {on_unknown!r}")
    return feature_columns(with_group_statistic(records, medians), keep)


def feature_columns(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The feature projection of records that already carry the median of their product."""
    labels = [TARGET] if TARGET in records.columns else []
    return records.select(
        "claim_id",
        *CATEGORICAL,
        "customer_age",
        "claim_amount",
        "annual_premium",
        days_between("incident_date", "start_date").alias("days_since_policy_start"),
        days_between("report_date", "incident_date").alias("report_delay_days"),
        ratio("claim_amount", MEDIAN).alias("amount_vs_product_median"),
        ratio("claim_amount", "annual_premium").alias("amount_vs_premium"),
        *labels,
        *keep,
    )


def claim_records(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims with the columns of their policy."""
    return claims.join(policies, "policy_id")


def fraud_features(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """The training table: every claim of a known policy, relative to the median over all of them.

    The join of claims and policies is stored once, with the columns that features need; both the medians and the
    features read it from there.
    """
    records = lineage_cut(
        claim_records(
            claims.select("claim_id", "policy_id", "incident_date", "report_date", "claim_amount", "channel", TARGET),
            policies.select("policy_id", "product", "region", "customer_age", "start_date", "annual_premium"),
        )
    )
    # stored, so that the join knows how small they are
    return claim_features(records, lineage_cut(group_medians(records)), on_unknown="keep")


# Weights of the three red flags in the label formula.
RED_FLAG_INTERCEPT = -4.0
EARLY_WEIGHT = 1.8
BIG_WEIGHT = 2.0
LATE_WEIGHT = 1.2


def red_flag_score(early: str | Column, big: str | Column, late: str | Column) -> Column:
    """Risk score of a claim from its three red flags."""
    terms = ((early, EARLY_WEIGHT), (big, BIG_WEIGHT), (late, LATE_WEIGHT))
    return logistic_score(terms, RED_FLAG_INTERCEPT)
