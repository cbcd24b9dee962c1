"""Raw files to bronze, silver, quarantine and gold, each heavy plan run once."""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from trustlake.operators.bounded import few_rows
from trustlake.operators.dedupe import COPIES
from trustlake.operators.gold import claims_monthly, fraud_features
from trustlake.operators.rules import (
    MAX_QUARANTINE_RATE,
    REPORT_SCHEMA,
    Ledger,
    QualityGateError,
    gate,
    observe_ledger,
)
from trustlake.plans.datasets import CLAIMS, POLICIES, Dataset, check, rules_of
from trustlake.session import get_spark
from trustlake.sources.raw import read_raw, with_lineage
from trustlake.sources.storage import GOOD, CatalogLayers, Snapshots, Staged

Layers = Snapshots | CatalogLayers


@dataclass
class Outcome:
    """What one run found and published."""

    run_id: str
    ledgers: dict[str, Ledger] = field(default_factory=dict)
    staged: dict[str, Staged] = field(default_factory=dict)

    @property
    def report(self) -> dict[str, dict]:
        return {name: ledger.as_dict() for name, ledger in self.ledgers.items()}


class RowsLostError(RuntimeError):
    """Good, bad and folded rows do not add up to the raw ones; nothing was published."""

    def __init__(self, name: str, raw_rows: int, ledger: Ledger) -> None:
        super().__init__(
            f"{name}: {raw_rows} raw rows, but {ledger.total_rows} checked and {ledger.duplicates_removed} folded ones"
        )


def load_bronze(layers: Layers, spec: Dataset, raw: DataFrame) -> None:
    """Keep the raw rows as they came, with their origin."""
    layers.write(raw, "bronze", spec.name)


def check_all(layers: Layers, specs: Sequence[Dataset], run_id: str) -> Outcome:
    """Check every dataset against the stored bronze, in order, so that later ones can refer to earlier ones.

    One write per dataset does it all: rows, counters of the ledger, and the split into outcomes. The raw rows are then
    counted, and none may be missing.
    """
    outcome = Outcome(run_id)
    for spec in specs:
        known = {r.dataset: layers.staged(outcome.staged[r.dataset], GOOD) for r in spec.references}
        bronze = layers.read("bronze", spec.name)
        rules = rules_of(spec, bronze)
        observed, counts = observe_ledger(check(spec, bronze, known), rules, COPIES)
        outcome.staged[spec.name] = layers.stage(observed.drop(COPIES), spec.name, run_id)
        ledger = outcome.ledgers[spec.name] = Ledger.from_counts(spec.name, counts.get, rules)
        raw_rows = bronze.count()
        if raw_rows != ledger.total_rows + ledger.duplicates_removed:
            raise RowsLostError(spec.name, raw_rows, ledger)
    return outcome


def save_report(layers: Layers, outcome: Outcome, spark: SparkSession) -> None:
    rows = [row for ledger in outcome.ledgers.values() for row in ledger.rows(outcome.run_id)]
    layers.append(few_rows(spark, rows, REPORT_SCHEMA), "reports", "quality")


def publish_silver(layers: Layers, outcome: Outcome, specs: Sequence[Dataset], limit: float) -> None:
    """Check every gated dataset before any of them becomes visible."""
    for spec in specs:
        if spec.gated:
            gate(outcome.ledgers[spec.name], limit)
    for handle in outcome.staged.values():
        layers.publish(handle, outcome.run_id)


def build_gold(layers: Layers, run_id: str) -> None:
    """Reporting and feature tables from the stored silver layer."""
    claims, policies = layers.read("silver", "claims"), layers.read("silver", "policies")
    layers.write(claims_monthly(claims, policies), "gold", "claims_monthly", run_id)
    layers.write(fraud_features(claims, policies), "gold", "fraud_features", run_id)


def run_medallion(
    spark: SparkSession,
    layers: Layers,
    raw: Mapping[str, DataFrame] | str,
    specs: Sequence[Dataset] = (POLICIES, CLAIMS),
    limit: float = MAX_QUARANTINE_RATE,
    multi_line: bool = False,
) -> Outcome:
    """The whole chain. ``raw`` is a folder of ``<name>.csv`` files (or folders) or the raw frames themselves.

    Every file's own header says where its columns are. Rows that cannot be read are kept and quarantined. Files whose
    quoted fields hold line breaks need ``multi_line=True``; they are split like others.

    The quality report is stored before the gate decides. When the gate fails, the staged rows stay readable for
    inspection while silver, quarantine and gold keep their previous version.
    """
    run_id = uuid.uuid4().hex
    for spec in specs:
        if isinstance(raw, str):
            path = f"{raw.rstrip('/')}/{spec.name}.csv"
            frame = with_lineage(read_raw(spark, path, spec.raw_columns, multi_line))
        else:
            frame = raw[spec.name]
        load_bronze(layers, spec, frame)
    outcome = check_all(layers, specs, run_id)
    save_report(layers, outcome, spark)
    publish_silver(layers, outcome, specs, limit)
    build_gold(layers, run_id)
    return outcome


@dataclass(frozen=True)
class MedallionConfig:
    """Command-line settings: folders below ``base_path``, or tables below ``tables`` (catalog.schema)."""

    base_path: str = "data"
    tables: str | None = None
    raw_dir: str | None = None
    limit: float = MAX_QUARANTINE_RATE
    multi_line: bool = False

    @property
    def raw(self) -> str:
        if self.raw_dir:
            return self.raw_dir
        if self.tables:
            raise ValueError("tables have no folder for raw files: give --raw-dir")
        return f"{self.base_path.rstrip('/')}/raw"

    def layers(self, spark: SparkSession) -> Layers:
        return CatalogLayers(spark, self.tables) if self.tables else Snapshots(spark, self.base_path)


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Raw files to bronze, silver, quarantine and gold.")
    parser.add_argument("--base-path", default="data")
    parser.add_argument("--tables", metavar="CATALOG.SCHEMA")
    parser.add_argument("--raw-dir")
    parser.add_argument("--limit", type=float, default=MAX_QUARANTINE_RATE)
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside quoted fields")
    config = MedallionConfig(**vars(parser.parse_args(argv)))
    spark = get_spark("trustlake-medallion")
    try:
        layers = config.layers(spark)
        outcome = run_medallion(spark, layers, config.raw, limit=config.limit, multi_line=config.multi_line)
    except QualityGateError as error:
        print(error)
        print(json.dumps(error.ledger.as_dict(), indent=2))
        return 1
    print(json.dumps(outcome.report, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
