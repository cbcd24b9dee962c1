"""Derived columns and exact money arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(28,6)"


def ratio(numerator: str | Column, denominator: str | Column, digits: int = 3) -> Column:
    """Rounded quotient; NULL rather than an error where the denominator is zero."""
    return F.round(F.try_divide(_column(numerator), _column(denominator)), digits)


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return F.date_diff(_column(later), _column(earlier))


def month_of(column: str | Column) -> Column:
    return F.date_trunc("month", _column(column)).cast("date")


def money(column: str | Column) -> Column:
    """An amount as a decimal, so that its sum does not depend on the order in which partitions arrive.

    Amounts count in millionths. NaN, infinities and amounts of 10^22 or more have no such decimal.
    """
    return _column(column).try_cast(MONEY_TYPE)


def _complete_total(column: str | Column) -> Column:
    """The sum, or NULL where some amount has no decimal: never the sum of a part."""
    missing = F.count(_column(column)) - F.count(money(column))
    return F.when(missing == 0, F.sum(money(column)))


def money_sum(column: str | Column, digits: int = 2) -> Column:
    return F.round(_complete_total(column), digits).cast("double")


def money_avg(column: str | Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(_complete_total(column), F.count(money(column))), digits).cast("double")


def logistic_score(terms: Sequence[tuple[str | Column, float]], intercept: float) -> Column:
    """``1 / (1 + exp(-(intercept + sum of the weights whose condition holds)))``; a NULL condition adds nothing."""
    total = F.lit(float(intercept))
    for condition, weight in terms:
        holds = F.expr(condition) if isinstance(condition, str) else condition
        total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
