"""From the stored feature table to a registered champion."""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from trustlake.operators.models import DEFAULT_REVIEW_RATE, MODEL_PARAMS, Trained, train
from trustlake.plans.medallion import Layers, MedallionConfig, Outcome, run_medallion
from trustlake.session import get_spark
from trustlake.sources.registry import ModelRegistry

MODEL_NAME = "claim-review"


def train_and_register(
    features: DataFrame,
    registry: ModelRegistry,
    model_name: str = MODEL_NAME,
    review_rate: float = DEFAULT_REVIEW_RATE,
    names: Sequence[str] = tuple(MODEL_PARAMS),
    params: Mapping[str, Mapping] | None = None,
) -> tuple[dict[str, Trained], str, int]:
    """Train every model, record each run, register the best. Returns (results, best model type, its version)."""
    results = train(features, names, review_rate, params)
    runs = {}
    for name, trained in results.items():
        settings = {**MODEL_PARAMS[name], **(params or {}).get(name, {})}
        runs[name] = registry.log_run(model_name, trained, review_rate, settings)
    best, version = registry.register_best(model_name, runs)
    return results, best, version


def run_all(
    spark: SparkSession,
    layers: Layers,
    raw: Mapping[str, DataFrame] | str,
    registry: ModelRegistry,
    limit: float,
    params: Mapping[str, Mapping] | None = None,
) -> tuple[Outcome, str, int]:
    """The three steps in order; a failing quality gate raises and so keeps training from running."""
    outcome = run_medallion(spark, layers, raw, limit=limit)
    _, best, version = train_and_register(layers.read("gold", "fraud_features"), registry, params=params)
    return outcome, best, version


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Train on the gold feature table and register the champion.")
    parser.add_argument("--base-path", default="data")
    parser.add_argument("--tables", metavar="CATALOG.SCHEMA")
    parser.add_argument("--features-path", help="a parquet folder instead of the gold layer")
    parser.add_argument("--registry", help="default: <base-path>/registry")
    parser.add_argument("--review-rate", type=float, default=DEFAULT_REVIEW_RATE)
    parser.add_argument("--max-iter", type=int, help="fewer iterations than the default, for a quick look")
    args = parser.parse_args(argv)
    spark = get_spark("trustlake-training")
    if args.features_path:
        features = spark.read.parquet(args.features_path)
    else:
        features = MedallionConfig(args.base_path, args.tables).layers(spark).read("gold", "fraud_features")
    registry = ModelRegistry(spark, args.registry or f"{args.base_path.rstrip('/')}/registry")
    params = {name: {"max_iter": args.max_iter} for name in MODEL_PARAMS} if args.max_iter else None
    results, best, version = train_and_register(features, registry, review_rate=args.review_rate, params=params)
    metrics = {name: trained.metrics for name, trained in results.items()}
    print(json.dumps({"metrics": metrics, "champion": best, "version": version}, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
