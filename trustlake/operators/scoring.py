"""Scoring whole tables with a fitted model and the statistics it was trained with."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.functions.cleaning import as_double, folded
from trustlake.operators.compiled import CompiledModel
from trustlake.operators.gold import CATEGORICAL, MEDIAN, NUMERIC, feature_columns, with_group_statistic
from trustlake.operators.models import SCORE, apply_model
from trustlake.operators.rules import FAILED, REQUEST_RULES, Rule, apply_rules, split_valid
from trustlake.session import lineage_cut

RAW_SCORE = "raw_score"
#: What a score is made from.
REQUEST_COLUMNS = (
    "claim_id", "policy_start_date", "start_date", "incident_date", "report_date", "claim_amount", "annual_premium", "customer_age",
    *CATEGORICAL,
)
STAT_KNOWN = Rule("product_has_median", f"{MEDIAN} IS NOT NULL")


@dataclass
class Scorer:
    """All that belongs to one model version."""

    model: PipelineModel | CompiledModel
    medians: DataFrame
    threshold: float
    version: str = "0"
    model_type: str = "unknown"
    rules: tuple[Rule, ...] = REQUEST_RULES
    numeric: Sequence[str] = NUMERIC
    score_digits: int = 4


def normalise_requests(requests: DataFrame) -> DataFrame:
    """The cleaning silver applies, for records that come straight from outside."""
    return requests.withColumns(
        {
            "claim_id": F.trim("claim_id"),
            "product": folded("product"),
            "region": F.trim("region"),
            "channel": F.coalesce(folded("channel"), F.lit("unknown")),
        }
    )


def check_requests(requests: DataFrame, scorer: Scorer) -> DataFrame:
    """Normalised requests with the median of their product and their broken rules.

    A product the model has no median for breaks a rule of its own.
    """
    known = with_group_statistic(normalise_requests(requests), scorer.medians)
    return apply_rules(known, (*scorer.rules, STAT_KNOWN))


def checked_once(requests: DataFrame, scorer: Scorer) -> DataFrame:
    """The outcome of ``check_requests``, stored with the columns that scores and refusals need: neither asks for the
    requests again."""
    needed = (*REQUEST_COLUMNS, MEDIAN, FAILED)
    checked = check_requests(requests, scorer)
    return lineage_cut(checked.select(*(c for c in checked.columns if c in needed)))


def score_features(features: DataFrame, scorer: Scorer) -> DataFrame:
    """(claim_id, fraud_score, flag_for_review, threshold, model_version, raw_score); the flag uses the raw score."""
    scored = apply_model(scorer.model, as_double(features, scorer.numeric), RAW_SCORE)
    return scored.select(
        "claim_id",
        F.round(RAW_SCORE, scorer.score_digits).alias(SCORE),
        (F.col(RAW_SCORE) >= F.lit(scorer.threshold)).alias("flag_for_review"),
        F.lit(scorer.threshold).alias("threshold"),
        F.lit(scorer.version).alias("model_version"),
        RAW_SCORE,
    )


def score_batch(requests: DataFrame, scorer: Scorer) -> tuple[DataFrame, DataFrame]:
    """(scores of the acceptable requests, rejected requests with the reasons); nothing is collected."""
    return score_checked(check_requests(requests, scorer), scorer)


def score_checked(checked: DataFrame, scorer: Scorer) -> tuple[DataFrame, DataFrame]:
    """The same for requests that ``check_requests`` has been over."""
    accepted, rejected = split_valid(checked)
    features = feature_columns(accepted.withColumnRenamed("policy_start_date", "start_date"))
    return score_features(features, scorer), rejected.drop(MEDIAN)


def rejection_reasons(rejected: DataFrame) -> DataFrame:
    """(claim_id, reasons): what a refused request is told."""
    return rejected.select("claim_id", F.array_join(FAILED, ", ").alias("reasons"))

