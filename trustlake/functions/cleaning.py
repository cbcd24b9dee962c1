"""Turning raw text columns into typed ones."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_cast(column: str | Column, to_type: str) -> Column:
    """Trimmed text as ``to_type``; text that is not a value of that type becomes NULL instead of failing the job."""
    return F.trim(column).try_cast(to_type)


def folded(column: str | Column) -> Column:
    """Trimmed lower-case text."""
    return F.lower(F.trim(column))


def null_if_blank(column: Column) -> Column:
    """NULL where only spaces are left after trimming."""
    return F.nullif(F.trim(column), F.lit(""))


def is_finite(column: str) -> str:
    """SQL condition: the number is neither NaN nor infinite. ``NaN > 0`` holds in SQL engines, so a plain range rule
    lets NaN through; the difference of a number with itself is 0 for finite ones only."""
    return f"{column} - {column} = 0"


@dataclass(frozen=True)
class Clean:
    """How one output column is made from one raw column.

    ``kind`` is ``text`` (trim), ``folded`` (trim and lower-case) or a SQL type name (safe cast).
    """

    name: str
    kind: str = "text"
    default: str | None = None
    source: str | None = None
    blank_is_null: bool = False

    @property
    def raw(self) -> str:
        return self.source or self.name

    def column(self) -> Column:
        raw = F.col(self.raw)
        if self.blank_is_null:
            raw = null_if_blank(raw)
        if self.kind == "text":
            value = F.trim(raw)
        elif self.kind == "folded":
            value = folded(raw)
        else:
            value = safe_cast(raw, self.kind)
        if self.default is not None:
            value = F.coalesce(value, F.lit(self.default))
        return value.alias(self.name)


def clean(df: DataFrame, columns: Iterable[Clean]) -> DataFrame:
    """One projection for the whole table."""
    return df.select(*(c.column() for c in columns))


def require_columns(df: DataFrame, needed: Iterable[str], table: str = "input") -> None:
    """Fail on the driver, before any job, when columns are missing."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{table} lacks the columns {', '.join(missing)}")


def as_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """All the named columns as double, the others untouched."""
    doubles = {c: F.col(c).cast("double") for c in columns}
    return df.withColumns(doubles) if doubles else df
