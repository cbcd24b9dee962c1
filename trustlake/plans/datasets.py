"""What a dataset is: its columns, key, references and rules; and the plan that checks it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.functions.cleaning import Clean
from trustlake.operators.dedupe import COPIES, dedupe
from trustlake.operators.relate import mark_existing
from trustlake.operators.rules import CLAIM_RULES, KEY_PRESENT, POLICY_RULES, Rule, apply_rules
from trustlake.sources.raw import MALFORMED


@dataclass(frozen=True)
class Reference:
    """The rows' ``on`` must occur among the valid rows of ``dataset``; the answer goes to column ``flag``."""

    dataset: str
    on: str
    flag: str


@dataclass(frozen=True)
class Dataset:
    name: str
    columns: tuple[Clean, ...]
    key: tuple[str, ...]
    rules: tuple[Rule, ...]
    order: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    gated: bool = False
    #: the date by whose month an incremental run files the rows
    day: str | None = None

    @property
    def raw_columns(self) -> list[str]:
        return [c.raw for c in self.columns]


# own rule: the raw row has the expected fields
READABLE = Rule("row_readable", f"{MALFORMED} IS NULL")


def rules_of(spec: Dataset, bronze: DataFrame) -> tuple[Rule, ...]:
    """The rules of a dataset; rows that come from raw files must have been readable."""
    return (READABLE, *spec.rules) if MALFORMED in bronze.columns else spec.rules


def typed(spec: Dataset, bronze: DataFrame) -> DataFrame:
    """The dataset's columns, cleaned and cast; rows that could not be read keep their text."""
    unread = [F.col(MALFORMED)] if MALFORMED in bronze.columns else []
    return bronze.select(*(c.column() for c in spec.columns), *unread)


def judge(spec: Dataset, rows: DataFrame, known: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows, one per key already, with the names of the rules they break."""
    for reference in spec.references:
        rows = mark_existing(rows, known[reference.dataset], reference.on, reference.flag)
    return apply_rules(rows, rules_of(spec, rows)).drop(*(r.flag for r in spec.references))


def check(spec: Dataset, bronze: DataFrame, known: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Typed, one row per key, every row with its broken rules and the number of raw rows it stands for."""
    return check_typed(spec, typed(spec, bronze), known)


def check_typed(spec: Dataset, rows: DataFrame, known: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The same for rows that ``typed`` has been over."""
    return judge(spec, dedupe(rows, spec.key, spec.order, copies=COPIES), known)


POLICIES = Dataset(
    name="policies",
    columns=(
        Clean("policy_id"),
        Clean("product", "folded"),
        Clean("region"),
        Clean("customer_age", "int"),
        Clean("start_date", "date"),
        Clean("end_date", "date"),
        Clean("annual_premium", "double"),
    ),
    key=("policy_id",),
    rules=POLICY_RULES,
    day="start_date",
)

CLAIMS = Dataset(
    name="claims",
    columns=(
        Clean("claim_id"),
        Clean("policy_id"),
        Clean("incident_date", "date"),
        Clean("report_date", "date"),
        Clean("claim_amount", "double"),
        Clean("channel", "folded", default="unknown"),
        Clean("description"),
        Clean("is_fraud", "int"),
    ),
    key=("claim_id",),
    rules=(KEY_PRESENT, *CLAIM_RULES),
    references=(Reference("policies", "policy_id", "_policy_found"),),
    gated=True,
    day="incident_date",
)
