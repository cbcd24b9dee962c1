"""How well an extractor reads labelled texts, kept as a record per evaluation."""

from __future__ import annotations

import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from trustlake.operators.bounded import few_rows
from trustlake.operators.extraction import (
    Extractor,
    attach,
    compare_with_labels,
    extract_distinct,
    extraction_accuracy,
)
from trustlake.session import lineage_cut

EVALUATION_SCHEMA = "extractor string, cases long, metrics map<string,double>, evaluated_at string"


def evaluate_extractor(
    cases: DataFrame, extractor: Extractor, key: str, text: str = "text", group: str = "group"
) -> tuple[dict[str, float], DataFrame, DataFrame]:
    """(metrics, the same per group as rows, cases with expected and got fields).

    Metrics are the accuracy per field and of all fields together, the share left to people, and the mean time per case.
    The groups, however many, stay a frame.
    """
    start = time.perf_counter()
    readings, _ = extract_distinct(cases, text, extractor)
    seconds = time.perf_counter() - start
    got = attach(cases.select(key, text), text, readings)
    compared = lineage_cut(compare_with_labels(got, cases, key, [group]))
    total = extraction_accuracy(compared).first().asDict()
    return total | {"seconds_per_claim": round(seconds / max(1, total["cases"]), 4)}, extraction_accuracy(compared, group), compared


def log_evaluation(spark: SparkSession, base: str, name: str, metrics: dict[str, float]) -> None:
    """Append one record, next to those of other extractors."""
    numbers = [(k, float(v)) for k, v in metrics.items() if k != "cases"]
    row = (name, int(metrics["cases"]), numbers, datetime.now(UTC).isoformat())
    few_rows(spark, [row], EVALUATION_SCHEMA).write.mode("append").json(f"{base.rstrip('/')}/evaluations")


def evaluations(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(EVALUATION_SCHEMA).json(f"{base.rstrip('/')}/evaluations")
