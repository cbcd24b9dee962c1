"""Declarative quality rules, their ledger and the publication gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trustlake.functions.cleaning import is_finite

FAILED = "_failed_rules"
VALID = "_is_valid"
MAX_QUARANTINE_RATE = 0.05


@dataclass(frozen=True)
class Rule:
    """A good row makes ``condition`` TRUE; FALSE and NULL both count as broken."""

    name: str
    condition: str

    def broken(self) -> Column:
        """A one-element array with the rule's name for a bad row, an empty one for a good row."""
        none = F.array().cast("array<string>")
        return F.when(F.expr(self.condition), none).otherwise(F.array(F.lit(self.name)))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the names of all broken rules, in the order in which the rules are declared."""
    names = [r.name for r in rules]
    if len(set(names)) != len(names):
        raise ValueError(f"rule names must be unique: {names}")
    none = F.array().cast("array<string>")
    return df.withColumn(FAILED, F.concat(none, *(r.broken() for r in rules)))


def is_valid() -> Column:
    return F.size(FAILED) == 0


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the rule column, bad rows with it)"""
    return checked.filter(is_valid()).drop(FAILED), checked.filter(~is_valid())


# --- the ledger --------------------------------------------------------------------------------------------------


def ledger_columns(rules: Sequence[Rule], copies: str | None = None) -> list[Column]:
    """Aggregates for one pass over a checked frame: totals, one counter per rule, duplicates folded into a row."""
    columns = [F.count(F.lit(1)).alias("total_rows"), F.count_if(~is_valid()).alias("quarantined_rows")]
    if copies is not None:
        columns.append(F.coalesce(F.sum(F.col(copies) - 1), F.lit(0)).cast("long").alias("duplicates_removed"))
    columns += [F.count_if(F.array_contains(FAILED, r.name)).alias(f"rule:{r.name}") for r in rules]
    return columns


@dataclass(frozen=True)
class Ledger:
    """Counts of one checked dataset."""

    dataset: str
    total_rows: int
    quarantined_rows: int
    failures_by_rule: dict[str, int]
    duplicates_removed: int = 0

    @classmethod
    def from_counts(cls, dataset: str, counts: dict, rules: Sequence[Rule]) -> Ledger:
        return cls(
            dataset=dataset,
            total_rows=int(counts["total_rows"]),
            quarantined_rows=int(counts["quarantined_rows"]),
            failures_by_rule={r.name: int(counts[f"rule:{r.name}"]) for r in rules},
            duplicates_removed=int(counts.get("duplicates_removed") or 0),
        )

    @property
    def valid_rows(self) -> int:
        return self.total_rows - self.quarantined_rows

    @property
    def quarantine_rate(self) -> float:
        return round(self.quarantined_rows / self.total_rows, 4) if self.total_rows else 0.0

    def as_dict(self) -> dict:
        return {
            "total_rows": self.total_rows,
            "valid_rows": self.valid_rows,
            "quarantined_rows": self.quarantined_rows,
            "quarantine_rate": self.quarantine_rate,
            "failures_by_rule": dict(self.failures_by_rule),
            "duplicates_removed": self.duplicates_removed,
        }

    def rows(self, run_id: str) -> list[tuple]:
        """One row per rule, for the report table."""
        totals = (self.total_rows, self.valid_rows, self.quarantined_rows, self.quarantine_rate, self.duplicates_removed)
        return [(run_id, self.dataset, rule, failed, *totals) for rule, failed in self.failures_by_rule.items()]


REPORT_SCHEMA = (
    "run_id string, dataset string, rule string, failed_rows long, total_rows long, valid_rows long, "
    "quarantined_rows long, quarantine_rate double, duplicates_removed long"
)


def observe_ledger(checked: DataFrame, rules: Sequence[Rule], copies: str | None = None) -> tuple[DataFrame, Observation]:
    """Count while the frame is being written, so that the ledger costs no pass of its own."""
    observation = Observation()
    return checked.observe(observation, *ledger_columns(rules, copies)), observation


def ledger_frame(checked: DataFrame, rules: Sequence[Rule], copies: str | None = None) -> DataFrame:
    """The totals as a one-row frame."""
    totals = checked.agg(*ledger_columns(rules, copies))
    keep = ["total_rows", "quarantined_rows"] + (["duplicates_removed"] if copies is not None else [])
    rate = F.round(F.try_divide(F.col("quarantined_rows"), F.col("total_rows")), 4)
    return totals.select(
        *keep,
        (F.col("total_rows") - F.col("quarantined_rows")).alias("valid_rows"),
        F.coalesce(rate, F.lit(0.0)).alias("quarantine_rate"),
    )


def failures_by_rule(checked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, failed_rows), one row per declared rule, zero where nothing failed; one aggregate, no explode."""
    counts = checked.agg(*ledger_columns(rules))
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(f"`rule:{r.name}`").alias("failed_rows")) for r in rules]
    return counts.select(F.inline(F.array(*pairs)))


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    """(rule, rows) over the rules that really occur in a quarantine table, most frequent first."""
    return (
        quarantine.select(F.explode(FAILED).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "rule")
    )


# --- the gate ----------------------------------------------------------------------------------------------------


class QualityGateError(RuntimeError):
    """Too many rows were quarantined; nothing was published."""

    def __init__(self, ledger: Ledger, limit: float) -> None:
        super().__init__(
            f"Quality gate failed for {ledger.dataset}: {ledger.quarantined_rows} of {ledger.total_rows} rows quarantined "
            f"(limit {limit:.0%}); nothing was published"
        )
        self.ledger = ledger


def gate(ledger: Ledger, limit: float = MAX_QUARANTINE_RATE) -> None:
    """Raise when more than the limit's share of the rows is quarantined; counts decide, not the rounded rate."""
    if ledger.quarantined_rows > Fraction(str(limit)) * ledger.total_rows:
        raise QualityGateError(ledger, limit)


# --- rule sets ---------------------------------------------------------------------------------------------------

# Names and conditions of the rules of the two claim feeds.
POLICY_RULES = (
    Rule("policy_id_present", "policy_id IS NOT NULL"),
    Rule("start_date_valid", "start_date IS NOT NULL"),
    Rule("end_after_start", "end_date > start_date"),
    Rule("premium_positive", "annual_premium > 0"),
    # own rule: NaN > 0 holds in SQL
    Rule("premium_finite", f"annual_premium IS NULL OR {is_finite('annual_premium')}"),
)

KEY_PRESENT = Rule("claim_id_present", "claim_id IS NOT NULL")

CLAIM_RULES = (
    Rule("claim_amount_present", "claim_amount IS NOT NULL"),
    Rule("claim_amount_positive", "claim_amount IS NULL OR claim_amount > 0"),
    Rule("incident_date_valid", "incident_date IS NOT NULL"),
    Rule("reported_after_incident", "report_date >= incident_date"),
    Rule("policy_exists", "_policy_found"),
    # own rule, as above
    Rule("claim_amount_finite", f"claim_amount IS NULL OR {is_finite('claim_amount')}"),
)


def member_of(column: str, allowed: Sequence[str]) -> str:
    """SQL condition: the value is one of a closed list."""
    quoted = ", ".join("'" + value.replace("'", "''") + "'" for value in allowed)
    return f"{column} IN ({quoted})"


def request_rules(
    products: Sequence[str], regions: Sequence[str], channels: Sequence[str], with_text: bool = False
) -> tuple[Rule, ...]:
    """What a record must satisfy before it is scored."""
    rules = [
        Rule("claim_id_present", "length(claim_id) >= 1"),
        Rule("product_known", member_of("product", products)),
        Rule("region_known", member_of("region", regions)),
        Rule("channel_known", member_of("channel", channels)),
        Rule("age_in_range", "customer_age BETWEEN 18 AND 120"),
        Rule("claim_amount_positive", f"claim_amount > 0 AND {is_finite('claim_amount')}"),
        Rule("premium_positive", f"annual_premium > 0 AND {is_finite('annual_premium')}"),
        Rule("start_date_valid", "policy_start_date IS NOT NULL"),
        Rule("incident_date_valid", "incident_date IS NOT NULL"),
        Rule("reported_after_incident", "report_date >= incident_date"),
    ]
    if with_text:
        rules.append(Rule("description_length", "length(description) BETWEEN 1 AND 2000"))
    return tuple(rules)


# The closed lists of the scoring interface.
PRODUCTS = ("auto", "home", "travel", "health")
REGIONS = ("Catalonia", "Madrid", "Andalusia", "Valencia", "Basque Country", "Galicia")
CHANNELS = ("web", "phone", "agent", "app", "unknown")

REQUEST_RULES = request_rules(PRODUCTS, REGIONS, CHANNELS)
