"""Append-only log records, rendered as JSON by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREDICTION_FIELDS = ("claim_id", "fraud_score", "flagged", "model_version", "latency_ms", "batch_size")
EXTRACTION_FIELDS = ("claim_id", "extractor", "damage_type", "urgency", "needs_manual_review", "extraction_ms")


def prediction_log(scored: DataFrame, latency_ms: float, batch_size: int) -> DataFrame:
    """(record): one JSON text per scored claim; latency and size are those of the whole batch."""
    filled = scored.select(
        "claim_id",
        "fraud_score",
        F.col("flag_for_review").alias("flagged"),
        "model_version",
        F.lit(float(latency_ms)).alias("latency_ms"),
        F.lit(int(batch_size)).alias("batch_size"),
    )
    return filled.select(F.to_json(F.struct(*PREDICTION_FIELDS)).alias("record"))


def extraction_log(extracted: DataFrame, extraction_ms: float) -> DataFrame:
    """(record): one JSON text per read description."""
    filled = extracted.withColumn("extraction_ms", F.lit(float(extraction_ms)))
    return filled.select(F.to_json(F.struct(*EXTRACTION_FIELDS)).alias("record"))


def append_log(records: DataFrame, path: str, run: str | None = None) -> None:
    """Add records to a log. Those of a named run replace what the same run wrote before."""
    if run is None:
        records.write.mode("append").text(path)
    else:
        records.write.mode("overwrite").text(f"{path}/run={run}")
