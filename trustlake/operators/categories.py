"""Category dictionaries of any size: every category of a column gets a dense number, in one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.operators.selection import prefix_sums
from trustlake.session import lineage_cut

#: Categories of one column that a fitted pipeline, which lists them, may have.
MOST_CATEGORIES = 10_000


def category_places(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, category, n, place): frequent categories first, equally frequent ones by name; a missing one has no place.

    Categories are counted before they are moved and numbered by prefix sums, so neither a hot category nor a column with as
    many categories as rows meets in one task, and nothing goes through the driver.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in columns]
    counted = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .select("cell.column", "cell.category")
        .filter("category IS NOT NULL")
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = F.struct((-F.col("n")).alias("rank"), "category").alias("order")
    numbered = prefix_sums(counted.select("column", order, F.lit(1).cast("bigint").alias("one")), ["column"], "order", ["one"])
    return numbered.select(
        "column", F.col("order.category").alias("category"), (-F.col("order.rank")).alias("n"), F.col("one_before").alias("place")
    )


def with_places(df: DataFrame, places: DataFrame, columns: Sequence[str], suffix: str = "_place") -> DataFrame:
    """Add the place of each column's category, NULL for a missing or an unknown one: a sparse one-hot row."""
    for c in columns:
        known = places.filter(F.col("column") == c).select(
            F.col("category").alias("_category"), F.col("place").alias(f"{c}{suffix}")
        )
        df = df.join(known, F.col(c).cast("string") == F.col("_category"), "left").drop("_category")
    return df


def known_categories(df: DataFrame, columns: Sequence[str], most: int = MOST_CATEGORIES) -> dict[str, list[str]]:
    """The categories of each column in the order of their places, for models that list them.

    A column with more than ``most`` is refused before anything is brought to the driver.
    """
    if not columns:
        return {}
    places = lineage_cut(category_places(df, columns))
    sizes = places.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    large = sorted((row["column"], row["n"]) for row in sizes.filter(F.col("n") > most).collect())
    if large:
        named = ", ".join(f"{column} ({n})" for column, n in large)
        raise ValueError(f"too many categories for one-hot places, at most {most} a column: {named}")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in places.orderBy("column", "place").collect():
        found[row["column"]].append(row["category"])
    return found
