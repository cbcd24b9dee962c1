"""Scoring and triage of whole tables, with their logs."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.operators.dedupe import dedupe
from trustlake.operators.extraction import Extractor, extract_rows, keyword_extractor, triage, unreadable
from trustlake.operators.scoring import Scorer, checked_once, rejection_reasons, score_checked
from trustlake.sources.logs import append_log, extraction_log, prediction_log


@dataclass(frozen=True)
class Served:
    """What one serving run wrote, and how many requests were answered or refused."""

    scores: str
    rejects: str
    scored_rows: int
    rejected_rows: int


def serve_batch(
    spark: SparkSession, requests: DataFrame, scorer: Scorer, target: str, run: str | None = None
) -> Served:
    """Write scores, refusals and one log record per score below ``target``.

    Every request is read, checked and scored once; log and counts are taken from the stored scores. Repeating a run by its
    name replaces its log records.
    """
    scores, rejects = f"{target}/scores", f"{target}/rejects"
    start = time.perf_counter()
    scored, rejected = score_checked(checked_once(requests, scorer), scorer)
    scored.write.mode("overwrite").parquet(scores)
    latency_ms = round((time.perf_counter() - start) * 1000, 1)
    rejection_reasons(rejected).write.mode("overwrite").parquet(rejects)
    stored = spark.read.parquet(scores)
    n = stored.count()
    append_log(prediction_log(stored, latency_ms, n), f"{target}/prediction_log", run or uuid.uuid4().hex)
    return Served(scores, rejects, n, spark.read.parquet(rejects).count())


def serve_triage(
    spark: SparkSession,
    requests: DataFrame,
    scorer: Scorer,
    target: str,
    extractor: Extractor | None = None,
    text: str = "description",
    run: str | None = None,
) -> DataFrame:
    """Score the requests and read the descriptions of those that were not refused.

    A claim that was sent more than once keeps all its scores and one description, so copies never pair up. The halves do
    not depend on each other: if the extractor fails as a whole, every description is left to people, under the name of the
    error, and the scores stand.
    """
    run = run or uuid.uuid4().hex
    served = serve_batch(spark, requests, scorer, target, run)
    scores = spark.read.parquet(served.scores)
    start = time.perf_counter()
    described = dedupe(requests.select(F.trim("claim_id").alias("claim_id"), text), ["claim_id"])
    described = described.join(scores.select("claim_id"), "claim_id", "left_semi")
    try:
        extracted = extract_rows(described, text, extractor or keyword_extractor())
    except Exception as error:  # noqa: BLE001 - a user's extractor may raise anything
        extracted = extract_rows(described, text, unreadable(f"failed: {type(error).__name__}"))
    extraction_ms = round((time.perf_counter() - start) * 1000, 1)
    append_log(extraction_log(extracted, extraction_ms), f"{target}/extraction_log", run)
    return triage(scores, extracted)
