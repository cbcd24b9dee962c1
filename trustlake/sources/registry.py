"""Runs, versions and aliases of fitted models, as append-only tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.operators.bounded import few_rows
from trustlake.operators.compiled import CompiledModel, compile_model
from trustlake.operators.models import Trained
from trustlake.operators.scoring import Scorer

CHAMPION = "champion"
RUN_SCHEMA = (
    "run_id string, model_name string, model_type string, path string, threshold double, review_rate double, "
    "n_train long, n_test long, metrics map<string,double>, params string, data_rows long, data_checksum string, "
    "created_at string"
)
VERSION_SCHEMA = "model_name string, version long, alias string, run_id string, moved_at string"


class ModelRegistry:
    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        for table, schema in (("runs", RUN_SCHEMA), ("versions", VERSION_SCHEMA)):
            few_rows(spark, [], schema).write.mode("ignore").json(f"{self.base}/{table}")

    def _append(self, table: str, schema: str, row: tuple) -> None:
        few_rows(self.spark, [row], schema).write.mode("append").json(f"{self.base}/{table}")

    def _table(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).json(f"{self.base}/{table}")

    def runs(self) -> DataFrame:
        return self._table("runs", RUN_SCHEMA)

    def moves(self) -> DataFrame:
        """Every alias move; the latest one of an alias is in force."""
        return self._table("versions", VERSION_SCHEMA)

    def log_run(self, model_name: str, trained: Trained, review_rate: float, params: Mapping) -> str:
        """Store a fitted model with its medians and record where it came from and how good it is."""
        run_id = uuid.uuid4().hex
        path = f"{self.base}/models/{run_id}"
        if isinstance(trained.model, PipelineModel):
            trained.model.write().save(f"{path}/model")
        compiled = trained.model if isinstance(trained.model, CompiledModel) else compile_model(trained.model)
        few_rows(self.spark, [(compiled.to_json(),)], "value string").write.text(f"{path}/compiled")
        trained.medians.write.parquet(f"{path}/medians")
        row = (
            run_id,
            model_name,
            trained.name,
            path,
            float(trained.threshold),
            float(review_rate),
            int(trained.n_train),
            int(trained.n_test),
            [(k, float(v)) for k, v in trained.metrics.items()],
            json.dumps(dict(params), sort_keys=True),
            int(trained.fingerprint.get("rows", 0)),
            str(trained.fingerprint.get("checksum", "")),
            datetime.now(UTC).isoformat(),
        )
        self._append("runs", RUN_SCHEMA, row)
        return run_id

    def move_alias(self, model_name: str, run_id: str, alias: str = CHAMPION, version: int | None = None) -> int:
        """Give the run the next version (or point back to an existing one) and make the alias mean it."""
        if version is None:
            last = self.moves().filter(F.col("model_name") == model_name).agg(F.max("version")).first()[0]
            version = 1 if last is None else last + 1
        moved_at = datetime.now(UTC).isoformat()
        self._append("versions", VERSION_SCHEMA, (model_name, version, alias, run_id, moved_at))
        return version

    def register_best(self, model_name: str, runs: Mapping[str, str], alias: str = CHAMPION) -> tuple[str, int]:
        """Of the given runs (model type to run id), register the one with the best average precision."""
        mine = self.runs().filter(F.col("run_id").isin(list(runs.values())))
        best = champion(mine.select("run_id", "model_type", F.col("metrics")["pr_auc"].alias("pr_auc")), "pr_auc").first()
        return best["model_type"], self.move_alias(model_name, best["run_id"], alias)

    def load(self, model_name: str, alias: str = CHAMPION) -> Scorer:
        """Resolve the alias to one run first, then take model, medians and threshold from that run only."""
        moved = self.moves().filter((F.col("model_name") == model_name) & (F.col("alias") == alias))
        move = moved.orderBy(F.desc("moved_at")).limit(1).first()
        if move is None:
            raise LookupError(f"no version of {model_name} has the alias {alias}")
        run = self.runs().filter(F.col("run_id") == move["run_id"]).first()
        return Scorer(
            model=CompiledModel.from_json(self.spark.read.text(f"{run['path']}/compiled", wholetext=True).first()["value"]),
            medians=self.spark.read.parquet(f"{run['path']}/medians"),
            threshold=run["threshold"],
            version=str(move["version"]),
            model_type=run["model_type"],
        )


    def load_uri(self, uri: str) -> Scorer:
        """Load ``models:/<name>@<alias>``."""
        return self.load(*parse_uri(uri))


def parse_uri(uri: str) -> tuple[str, str]:
    """``models:/<name>@<alias>`` as (name, alias)."""
    head, _, rest = uri.partition("models:/")
    name, at, alias = rest.partition("@")
    if head or not (name and at and alias):
        raise ValueError(f"expected models:/<name>@<alias>, got {uri!r}")
    return name, alias


def champion(results: DataFrame, metric: str) -> DataFrame:
    """The row with the highest metric, ties broken by the other columns; one row, one aggregate."""
    others = [c for c in results.columns if c != metric]
    best = results.agg(F.max(F.struct(metric, *others)).alias("_best"))
    return best.select(*(F.col("_best").getField(c).alias(c) for c in results.columns))
