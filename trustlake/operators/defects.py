"""Known defects, injected on purpose to prove that the rules catch them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.functions.hashing import chosen


@dataclass(frozen=True)
class Defect:
    """Replace ``column`` by ``replacement`` in about ``share`` of the rows; the key's hash decides which."""

    name: str
    column: str
    replacement: Column
    share: float


def claim_defects() -> tuple[Defect, ...]:
    """The defects of real claim feeds, with their usual shares."""
    return (
        Defect("d1", "claim_amount", F.lit(None), 0.01),
        Defect("d2", "channel", F.lit(None), 0.01),
        Defect("d3", "claim_amount", -F.abs("claim_amount"), 0.005),
        Defect("d4", "report_date", F.date_sub("incident_date", 10), 0.005),
        Defect("d5", "policy_id", F.lit("POL999999"), 0.005),
    )


def inject(df: DataFrame, defects: tuple[Defect, ...], key: str, seed: object = 42) -> DataFrame:
    """Apply the defects in order; they are drawn independently, so a row may receive several."""
    for d in defects:
        hit = chosen(f"{seed}|{d.name}", d.share, key)
        kind = df.schema[d.column].dataType
        df = df.withColumn(d.column, F.when(hit, d.replacement.cast(kind)).otherwise(F.col(d.column)))
    return df


def inject_duplicates(df: DataFrame, key: str, share: float = 0.01, seed: object = 42) -> DataFrame:
    """Repeat about ``share`` of the rows exactly, in one pass over the input."""
    copies = F.when(chosen(f"{seed}|d6", share, key), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")
