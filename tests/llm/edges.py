"""Documents as awkward as a corpus has them, with columns named like the operators' own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CLASHES = ["key", "_row", "digest", "rank", "kept", "fp", "score", "label", "hash", "doc_key", "sequence_id", "Text_"]
LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "Alpha beta gamma delta epsilon zeta eta theta."),
    (None, None),
    (5, "one"),
    (5, "one"),
    (6, "Alpha  beta gamma delta\nepsilon zeta eta theta."),
    (7, LONG),
    (8, LONG),
    (9, "ÉÀ ß 日本 — “quoted” 1234 x\x00y"),
    (-3, "one"),
    (5, "two"),
]


def awkward(spark: SparkSession, rows=None) -> DataFrame:
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *(c[0] for c in CLASHES)) for r in (ROWS if rows is None else rows)], schema)


def empty(spark: SparkSession) -> DataFrame:
    return awkward(spark, [])


def plain(rows) -> list[tuple]:
    """Rows in an order that nulls do not break."""
    return sorted((tuple(r) for r in rows), key=repr)
