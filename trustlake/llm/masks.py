"""Bit masks for covering locality-sensitive hashing.

Every bit gets one of the non-zero vectors of ``radius + 1`` bits in turn. The mask of a vector ``v`` holds the bits whose
vector has an odd inner product with ``v``. For any ``radius`` bits some ``v`` is orthogonal to all of their vectors, so its
mask holds none of these bits: two fingerprints that differ in at most ``radius`` bits agree under some mask.
"""

from __future__ import annotations

from collections.abc import Sequence


def covering_masks(bits: Sequence[int], radius: int) -> list[int]:
    """2^(radius+1) - 1 masks over the given bit positions."""
    vectors = 2 ** (radius + 1) - 1
    given = {bit: place % vectors + 1 for place, bit in enumerate(bits)}
    return [sum(1 << b for b, u in given.items() if (u & v).bit_count() % 2) for v in range(1, vectors + 1)]


def free_bits(mask: int, bits: Sequence[int]) -> list[int]:
    """The positions among ``bits`` that ``mask`` leaves open."""
    return [b for b in bits if not mask >> b & 1]


def signed(value: int) -> int:
    """A 64-bit pattern as Spark's bigint."""
    return value - 2**64 if value >= 2**63 else value
