"""Compare two large tables by digests first, and by rows only where the digests differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.operators.bounded import side_by_side
from trustlake.operators.relate import reconcile
from trustlake.session import lineage_cut

#: Rows that a leaf of the tree holds on average, and the bits that one level of the tree adds.
LEAF_ROWS = 64
LEVEL_BITS = 4
MAX_BITS = 48

NODE = "_node"
_DIGESTS = ("_one", "_two")


def leaf_bits(rows: int) -> int:
    """Bits of the key's hash that name a leaf, so that it holds about ``LEAF_ROWS`` rows at any size of the table."""
    bits = LEVEL_BITS
    while bits < MAX_BITS and (LEAF_ROWS << bits) < rows:
        bits += LEVEL_BITS
    return bits


def _hashed(salt: int, columns: Sequence[str]) -> Column:
    """64 bits over values and over which of them are missing (a hash alone passes over missing values)."""
    return F.xxhash64(F.lit(salt), *(F.col(c) for c in columns), *(F.col(c).isNull() for c in columns))


def _node(key: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(_hashed(0, key), 64 - bits)


def digest_leaves(df: DataFrame, key: Sequence[str], columns: Sequence[str], bits: int, unique: bool = False) -> DataFrame:
    """``_node, rows, keys, _one, _two``: by leaf the number of rows and of keys, and two sums of hashes of its rows.

    Sums do not depend on the order of rows and count copies, and they are decimals, so they never overflow. Each row sends
    at most one small record per task and leaf, never its content. ``unique`` says that no key occurs twice, so that rows
    need not be told apart by key.
    """
    whole = [*key, *columns]
    hashes = [_hashed(salt, whole).cast("decimal(20,0)").alias(name) for salt, name in enumerate(_DIGESTS, 1)]
    known = df.select(_node(key, bits).alias(NODE), _hashed(3, key).alias("_key"), *hashes)
    keys = F.count(F.lit(1)) if unique else F.count_distinct("_key")
    return known.groupBy(NODE).agg(
        F.count(F.lit(1)).alias("rows"), keys.alias("keys"), *(F.sum(d).alias(d) for d in _DIGESTS)
    )


def roll_up(leaves: DataFrame, levels: int = 1) -> DataFrame:
    """The nodes ``levels`` above: digests of the children added up."""
    parent = F.shiftrightunsigned(NODE, LEVEL_BITS * levels).alias(NODE)
    return leaves.groupBy(parent).agg(*(F.sum(c).alias(c) for c in ("rows", "keys", *_DIGESTS)))


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """``_node`` of the nodes whose digests are not the same in both trees."""
    sides = [frame.select(NODE, F.struct("rows", *_DIGESTS).alias(name)) for name, frame in (("_l", left), ("_r", right))]
    return sides[0].join(sides[1], NODE, "full").filter(~F.col("_l").eqNullSafe(F.col("_r"))).select(NODE)


def differing_leaves(left: DataFrame, right: DataFrame, bits: int) -> DataFrame:
    """``_node`` of the leaves that differ, found from the top of the trees down.

    Each level compares only the children of nodes that differ, so for equal tables the work ends at the root's 16 children.
    """
    suspects = None
    for above in range(bits // LEVEL_BITS - 1, -1, -1):
        pair = [roll_up(side, above) if above else side for side in (left, right)]
        if suspects is not None:
            parent = F.shiftrightunsigned(NODE, LEVEL_BITS)
            below = suspects.withColumnRenamed(NODE, "_parent")
            pair = [side.join(below, parent == F.col("_parent"), "left_semi") for side in pair]
        suspects = lineage_cut(_differing(*pair))
        if suspects.isEmpty():
            break
    return suspects


def rows_of_leaves(df: DataFrame, key: Sequence[str], leaves: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` that lie in ``leaves``, whose list is stored, so that Catalyst knows its size."""
    return df.withColumn(NODE, _node(key, bits)).join(leaves, NODE, "left_semi").drop(NODE)


def reconcile_by_digest(
    left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str], unique: bool = False
) -> DataFrame:
    """What ``reconcile`` finds, without moving rows of leaves that are equal on both sides.

    ``unique`` promises that the keys of at least one side are unique; a leaf that is equal on both sides then has no
    copies. Without it keys are counted by leaf, which moves one hash per key. Both tables are read twice, and must give the
    same rows both times. Two leaves count as equal if their row counts and 128 bits of digests agree.

    A missing key is a key; empty tables give zeros. Columns must have one type on both sides.
    """
    key, columns = list(key), list(columns)
    if len(set(key + columns)) < len(key + columns):
        raise ValueError("a column is named twice")
    types = [{c: frame.schema[c].dataType for c in (*key, *columns)} for frame in (left, right)]
    if types[0] != types[1]:
        raise ValueError(f"different types: {[c for c in types[0] if types[0][c] != types[1][c]]}")
    left, right = (frame.select(*key, *columns) for frame in (left, right))
    bits = leaf_bits(max(left.count(), right.count()))
    trees = [lineage_cut(digest_leaves(frame, key, columns, bits, unique)) for frame in (left, right)]
    leaves = differing_leaves(*trees, bits)
    same = trees[0].join(leaves, NODE, "left_anti")
    equal = same.agg(
        F.coalesce(F.sum("keys"), F.lit(0)).alias("_keys"),
        F.coalesce(F.sum(F.col("rows") - F.col("keys")), F.lit(0)).alias("_copies"),
    )
    found = reconcile(*(rows_of_leaves(frame, key, leaves, bits) for frame in (left, right)), key, columns)
    totals = ["compared", "only_left", "only_right", "copies_left", "copies_right"]
    lines = found.agg(F.collect_list(F.struct("column", "mismatches")).alias("_lines"), *(F.max(c).alias(c) for c in totals))
    both = side_by_side(lines, equal)
    added = {"compared": "_keys", "copies_left": "_copies", "copies_right": "_copies"}
    return both.select(
        F.inline("_lines"), *(F.col(c) + F.col(added[c]) if c in added else F.col(c) for c in totals)
    ).toDF("column", "mismatches", *totals)
