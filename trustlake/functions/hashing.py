"""Choices that depend only on the row's key, never on its position or partition."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hex digits of a hash, all of which decide.
HASH_DIGITS = 32


def keyed_hash(seed: object, *keys: str | Column) -> Column:
    """Hex md5 of the seed and the keys. Same text, same hash, on every engine."""
    parts = [F.coalesce(_column(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def share_cut(share: float) -> str:
    """The hash below which ``share`` of all hashes fall."""
    if not 0 <= share <= 1:
        raise ValueError(f"share must be between 0 and 1, got {share}")
    span = 16**HASH_DIGITS
    return "g" if share == 1 else format(int(Fraction(share) * span), f"0{HASH_DIGITS}x")


def chosen(seed: object, share: float, *keys: str | Column) -> Column:
    """True for about ``share`` of the keys, always the same ones."""
    return keyed_hash(seed, *keys) < F.lit(share_cut(share))


def _column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key
