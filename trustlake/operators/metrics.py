"""Ranking and flagging metrics of a scored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.operators.bounded import side_by_side
from trustlake.operators.selection import group_quantile, prefix_sums


def known_score(score: str) -> Column:
    """A score that can be ranked; NaN counts as missing."""
    value = F.col(score).cast("double")
    return F.when(~F.isnan(value), value)


def running_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: ``pos``, ``neg``, the numbers strictly below it, and both grand totals.

    Rows without a score or a label do not count. Equal scores, however many, become one row on the map side.
    """
    by_score = (
        df.select(known_score(score).alias("score"), F.col(label).cast("int").alias("_y"))
        .filter("score IS NOT NULL AND _y IS NOT NULL")
        .groupBy("score")
        .agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
    )
    placed = prefix_sums(by_score, [], "score", ["pos", "neg"])
    renamed = {"pos_before": "pos_below", "neg_before": "neg_below", "pos_total": "positives", "neg_total": "negatives"}
    return placed.withColumnsRenamed(renamed)


def ranking_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: ``roc_auc`` (ties count half) and ``average_precision`` (step-wise area over distinct thresholds)."""
    running = running_counts(df, score, label)
    flagged_pos = F.col("positives") - F.col("pos_below")
    flagged_all = flagged_pos + F.col("negatives") - F.col("neg_below")
    beaten = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))
    precision = flagged_pos.cast("double") / flagged_all
    totals = running.agg(
        F.sum(beaten).alias("_wins"),
        F.sum(F.col("pos") * precision).alias("_steps"),
        F.max("positives").cast("double").alias("_p"),
        F.max("negatives").cast("double").alias("_n"),
    )
    return totals.select(
        F.try_divide(F.col("_wins"), F.col("_p") * F.col("_n")).alias("roc_auc"),
        F.try_divide(F.col("_steps"), F.col("_p")).alias("average_precision"),
    )


def confusion(df: DataFrame, flag: str, label: str) -> DataFrame:
    """(label, flagged, rows): all four cells, also the empty ones, from one aggregate."""
    cells = [(y, f) for y in (0, 1) for f in (False, True)]
    counts = df.agg(
        *(F.count_if((F.col(label) == y) & (F.col(flag) == F.lit(f))).alias(f"_{y}{int(f)}") for y, f in cells)
    )
    rows = [
        F.struct(F.lit(y).alias("label"), F.lit(f).alias("flagged"), F.col(f"_{y}{int(f)}").alias("rows"))
        for y, f in cells
    ]
    return counts.select(F.inline(F.array(*rows)))


def flag_metrics(df: DataFrame, flag: str, label: str) -> DataFrame:
    """One row of count metrics over the rows that have a label and a flag; precision is 0 where nothing was flagged."""
    hit = F.count_if((F.col(label) == 1) & F.col(flag))
    counts = df.filter(F.col(label).isNotNull() & F.col(flag).isNotNull()).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(label) == 1).alias("_p"),
        F.count_if(F.col(flag)).alias("_f"),
        hit.alias("_tp"),
    )
    right = F.col("_n") - F.col("_p") - F.col("_f") + 2 * F.col("_tp")

    def share(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return counts.select(
        share(F.col("_tp"), F.col("_f")).alias("precision"),
        share(F.col("_tp"), F.col("_p")).alias("recall"),
        share(F.col("_f"), F.col("_n")).alias("flagged_rate"),
        share(right, F.col("_n")).alias("accuracy"),
        share(F.col("_n") - F.col("_p"), F.col("_n")).alias("accuracy_if_never_fraud"),
    )


def evaluate(df: DataFrame, score: str, label: str, threshold: float, digits: int = 4) -> DataFrame:
    """All metrics of one scored table at one threshold, rounded; one row."""
    flagged = df.withColumn("_flag", known_score(score) >= F.lit(threshold))
    both = ranking_metrics(df, score, label).withColumnRenamed("average_precision", "pr_auc")
    pair = side_by_side(both, flag_metrics(flagged, "_flag", label))
    return pair.select(*(F.round(c, digits).alias(c) for c in pair.columns))


def review_threshold(df: DataFrame, score: str, review_rate: float) -> float:
    """The score above which about ``review_rate`` of the rows lie (interpolated quantile)."""
    scores = df.select(known_score(score).alias("_score"))
    return group_quantile(scores, [], "_score", 1 - review_rate, "threshold").first()["threshold"]
