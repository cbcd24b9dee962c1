"""A trie of conversations: every distinct sequence of first turns is a node, with totals over the subtree below it.

Conversations are first rebuilt: the first ``h`` turns come from the conversation that ``head_of`` names, the others are their
own. A node is named by a digest of its turns. Turns have places from prefix sums, and the digest of a sequence is the sum
of the digests of its placed turns, so that prefix sums give it for every depth: no conversation, however long, is gathered.

Totals over subtrees come from a centroid decomposition of the parent edges. A component of the forest is split at its
centroid, the deepest node that has more than half of it below; what hangs below the centroid is summed and added to the nodes
on the path from the centroid to the component's top; then the parts are components of their own. Every node
lies in at most log2(n) components, and a node with any number of children is split by one step. Components of more
than ``local`` nodes are split by joins, all of one size class at a time; smaller ones go to tasks whole, which go on in the same way.

Defined results: turns are ordered by turn, a null one first; turns of one number by role, then by the digest of
the turn. Null roles and texts are empty. Rows that are equal throughout are turns of their own. Turns without a
conversation's id belong to none. ``c % 5`` is SQL's (a negative c gives a remainder of zero or below). An empty table gives
an empty trie, without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.frames import record
from trustlake.operators.selection import prefix_sums
from trustlake.session import lineage_cut

#: Longest head that ``head_length`` gives.
HEAD = 8
#: Most nodes of a component that one task takes whole.
LOCAL = 4096
#: Conversations per piece of a node's list of ends.
PIECE = 4096
LIMBS = ["limb0", "limb1"]


def head_length(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % (HEAD + 1)


def head_of(conv: Column) -> Column:
    return conv - conv % 5


def placed_turns(turns: DataFrame) -> DataFrame:
    """``conv, place, own, digest, size``: every turn's place in its conversation, from 0, and the number of its turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat_ws("|", F.octet_length(role).cast("string"), role, text), 256)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.struct(
            F.col("turn").cast("bigint").alias("turn"),
            role.alias("role"),
            digest.alias("digest"),
            F.monotonically_increasing_id().alias("any"),  # spreads rows that are equal throughout
        ).alias("order"),
        F.octet_length(text).cast("bigint").alias("size"),
        F.lit(1).cast("bigint").alias("one"),
    )
    placed = prefix_sums(rows, ["conv"], "order", ["one"])
    return placed.select(
        "conv",
        F.col("one_before").alias("place"),
        F.col("one_total").alias("own"),
        F.col("order.digest").alias("digest"),
        "size",
    )


def rebuilt_turns(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, depth, digest, size`` of the rebuilt conversations, depths from 1; and ``conv, length`` of all of them."""
    convs = placed.filter("place = 0").select("conv", "own", head_of(F.col("conv")).alias("head"), head_length(F.col("conv")).alias("h"))
    sources = placed.filter(F.col("place") < HEAD).select(
        F.col("conv").alias("head"), "place", F.col("own").alias("head_own"), "digest", "size"
    )
    borrowed = (
        convs.join(sources, "head")
        .filter(F.col("place") < F.col("h"))
        .select("conv", (F.col("place") + 1).alias("depth"), "digest", "size")
    )
    lengths = convs.join(sources.filter("place = 0").select("head", "head_own"), "head", "left").select(
        "conv",
        "h",
        F.least("h", F.coalesce("head_own", F.lit(0))).alias("taken"),
        F.greatest(F.col("own") - F.col("h"), F.lit(0)).alias("kept"),
    )
    kept = (
        placed.join(lengths, "conv")
        .filter(F.col("place") >= F.col("h"))
        .select("conv", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "digest", "size")
    )
    return borrowed.unionByName(kept), lengths.select("conv", (F.col("taken") + F.col("kept")).alias("length"))


def _limb(digest: Column, place: int) -> Column:
    return F.conv(F.substring(digest, 1 + 15 * place, 15), 16, 10).cast("decimal(38,0)")


def _name(*limbs: Column) -> Column:
    """The name of a sequence of turns, given the sums over its placed turns; 32 bytes."""
    return F.unhex(F.sha2(F.concat_ws("|", *(limb.cast("string") for limb in limbs)), 256))


def paths(rebuilt: DataFrame, lengths: DataFrame) -> DataFrame:
    """``conv, depth, node, parent, size, length``: the nodes on every conversation's path, the root (depth 0) included."""
    item = F.sha2(F.concat_ws("|", F.col("depth").cast("string"), "digest"), 256)
    limbs = rebuilt.select("conv", "depth", "size", item.alias("item")).select(
        "conv", "depth", "size", *(_limb(F.col("item"), i).alias(c) for i, c in enumerate(LIMBS))
    )
    summed = prefix_sums(limbs, ["conv"], "depth", LIMBS)
    zero = [F.lit(0).cast("decimal(38,0)")] * len(LIMBS)
    below = summed.select(
        "conv",
        "depth",
        _name(*((F.col(f"{c}_before") + F.col(c)).cast("decimal(38,0)") for c in LIMBS)).alias("node"),
        _name(*(F.col(f"{c}_before").cast("decimal(38,0)") for c in LIMBS)).alias("parent"),
        "size",
    )
    roots = lengths.select(
        "conv",
        F.lit(0).cast("bigint").alias("depth"),
        _name(*zero).alias("node"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("bigint").alias("size"),
    )
    return lineage_cut(below.unionByName(roots).join(lengths, "conv"))


def trie_nodes(path: DataFrame) -> DataFrame:
    """``node, parent, conv, depth, convs, children, weight, leaf, saved``.

    ``conv`` is the smallest member, ``weight`` the number of nodes of the subtree: every conversation counts the nodes
    that it is the smallest member of at each node of its path, but for those above that node.
    """
    nodes = lineage_cut(
        path.groupBy("node").agg(
            F.min("conv").alias("conv"),
            F.first("depth").alias("depth"),
            F.first("parent").alias("parent"),
            F.first("size").alias("size"),
            F.count("*").alias("convs"),
        )
    )
    firsts = nodes.groupBy(F.col("conv")).agg(F.count("*").alias("firsts"))
    weighed = path.join(firsts, "conv").groupBy("node").agg(F.sum("firsts").alias("below"))
    ends = path.filter("depth = 0").select("conv", "length")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"))
    full = (
        nodes.join(children, "node", "left")
        .join(weighed, "node")
        .join(firsts, "conv")
        .join(ends, "conv")
        # the smallest member's own nodes above this one
        .withColumn("above", F.col("depth") - 1 - (F.col("length") - F.col("firsts")))
    )
    return lineage_cut(
        full.select(
            "node",
            "parent",
            "conv",
            "depth",
            "convs",
            F.coalesce("children", F.lit(0)).cast("bigint").alias("children"),
            (F.col("below") - F.col("above")).alias("weight"),
            F.when(F.col("children").isNull(), 1).otherwise(0).cast("bigint").alias("leaf"),
            ((F.col("convs") - 1) * F.col("size")).alias("saved"),
        )
    )


def centroid_sums(parents: list[int], values: list[list[int]]) -> list[list[int]]:
    """The sums of ``values`` over the subtrees of a forest in one task, by its centroids; ``parents`` has -1 for tops."""
    count = len(parents)
    children: list[list[int]] = [[] for _ in range(count)]
    tops = []
    for node, parent in enumerate(parents):
        (children[parent] if parent >= 0 else tops).append(node)
    totals = [[0] * count for _ in values]
    split = [False] * count
    weight = [0] * count
    while tops:
        top = tops.pop()
        order = [top]
        for node in order:  # grows while it is walked: a node, then what is below it
            order += [c for c in children[node] if not split[c]]
        for node in order:
            weight[node] = 1
        for node in reversed(order[1:]):
            weight[parents[node]] += weight[node]
        centroid, path = top, [top]
        while True:
            heavy = [c for c in children[centroid] if not split[c] and 2 * weight[c] > len(order)]
            if not heavy:
                break
            centroid = heavy[0]
            path.append(centroid)
        below = [centroid]
        for node in below:
            below += [c for c in children[node] if not split[c]]
        for total, value in zip(totals, values, strict=True):
            part = sum(value[node] for node in below)
            for node in path:
                total[node] += part
        split[centroid] = True
        tops += [c for c in children[centroid] if not split[c]]
        if centroid != top:
            tops.append(top)
    return totals


SUMS = ["leaves", "saved_below"]
VALUES = ["leaf", "saved"]


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components, one after the other, as their nodes' totals."""
    schema = pa.schema([("node", pa.binary()), *((c, pa.int64()) for c in SUMS)])

    def summed(rows: list[tuple]) -> pa.RecordBatch:
        place = {row[1]: i for i, row in enumerate(rows)}
        parents = [place.get(row[2], -1) for row in rows]
        totals = centroid_sums(parents, [[row[3 + i] for row in rows] for i in range(len(VALUES))])
        done = [[row[3 + len(VALUES) + i] + t for row, t in zip(rows, totals[i], strict=True)] for i in range(len(SUMS))]
        return record(schema, [row[1] for row in rows], *done)

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            # several whole components make one batch
            if held and row[0] != held[-1][0] and len(held) >= LOCAL:
                yield summed(held)
                held = []
            held.append(row)
    if held:
        yield summed(held)


def subtree_sums(nodes: DataFrame, path: DataFrame, local: int = LOCAL) -> DataFrame:
    """``node, leaves, saved_below``: the sums of ``leaf`` and ``saved`` over each node's subtree.

    ``path`` tells a node's ancestor at any depth: it is on the path of the node's conversation.
    """
    kept = ["node", "parent", "conv", "depth", "weight", *VALUES, *SUMS]
    live = nodes.withColumns({c: F.lit(0).cast("bigint") for c in SUMS})
    live = live.select(*kept, F.lit(b"").alias("top"))  # one tree at first
    steps = path.select("conv", F.col("depth").alias("at"), F.col("node").alias("at_node"), F.col("parent").alias("at_parent"))
    waiting, done = [], []
    while True:
        live = lineage_cut(live)
        sizes = live.groupBy("top").agg(F.count("*").alias("nodes"), F.min("depth").alias("top_depth"))
        sized = lineage_cut(live.join(lineage_cut(sizes), "top"))
        waiting.append(sized.filter(F.col("nodes") <= local).select("top", "node", "parent", *VALUES, *SUMS))
        large = sized.filter(F.col("nodes") > local)
        # the deepest node with more than half of its component at or below it
        centroids = lineage_cut(
            large.filter(2 * F.col("weight") > F.col("nodes"))
            .groupBy("top")
            .agg(F.min_by(F.struct("node", "conv", "depth", "weight", "top_depth"), "weight").alias("c"))
        )
        if centroids.isEmpty():
            break
        # for each node, the ancestor just below the centroid's depth: it is the top of a part if its parent is the centroid
        stepped = large.join(centroids, "top").withColumn("at", F.col("c.depth") + 1).join(steps, ["conv", "at"], "left")
        hangs = (F.col("depth") > F.col("c.depth")) & (F.col("at_parent") == F.col("c.node"))
        here = lineage_cut(
            stepped.select(
                *kept,
                "top",
                "at_node",
                F.coalesce(hangs, F.lit(False)).alias("hangs"),
                (F.col("node") == F.col("c.node")).alias("centroid"),
            )
        )
        parts = here.filter("hangs OR centroid").groupBy("top").agg(*(F.sum(v).alias(f"part_{v}") for v in VALUES))
        climbed = (
            centroids.join(parts, "top")
            .withColumn("conv", F.col("c.conv"))
            .join(steps, "conv")
            .filter((F.col("at") >= F.col("c.top_depth")) & (F.col("at") <= F.col("c.depth")))
            .select(F.col("at_node").alias("node"), F.col("c.weight").alias("part_weight"), *(f"part_{v}" for v in VALUES))
        )
        added = here.join(climbed, "node", "left").withColumns(
            {
                **{s: F.col(s) + F.coalesce(f"part_{v}", F.lit(0)) for s, v in zip(SUMS, VALUES, strict=True)},
                # what hangs on the centroid is no longer below the nodes above it
                "weight": F.col("weight") - F.when(F.col("hangs"), 0).otherwise(F.coalesce("part_weight", F.lit(0))),
                "top": F.when(F.col("hangs"), F.col("at_node")).otherwise(F.col("top")),
            }
        )
        added = lineage_cut(added.select(*kept, "top", "centroid"))
        done.append(added.filter("centroid").select("node", *SUMS))
        live = added.filter("NOT centroid").drop("centroid")
    ready = reduce(DataFrame.unionByName, waiting).repartition("top").sortWithinPartitions("top")
    finished = ready.mapInArrow(_finish, "node binary, " + ", ".join(f"{c} bigint" for c in SUMS))
    return reduce(DataFrame.unionByName, done, finished)


NO_ENDS = hashlib.sha256(b"").hexdigest()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 over all pieces of a node, one piece at a time."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, state = None, hashlib.sha256()
    for batch in batches:
        for own, ids in zip(batch["node"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if own != node:
                if node is not None:
                    yield record(schema, [node], [state.hexdigest()])
                node, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if node is not None:
        yield record(schema, [node], [state.hexdigest()])


def end_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """``node, ends_sha256`` from ``node, conv``: a digest of the sorted ids, of which no task holds more than a piece."""
    ranked = prefix_sums(ends.withColumn("one", F.lit(1).cast("bigint")), ["node"], "conv", ["one"])
    pieces = (
        ranked.groupBy("node", F.floor(F.col("one_before") / piece).alias("piece"))
        .agg(F.array_sort(F.collect_list("conv")).alias("ids"), F.first("one_total").alias("total"))
        .withColumn("ids", F.concat_ws(",", F.transform("ids", lambda c: c.cast("string"))))
    )
    pieces = lineage_cut(pieces)
    several = pieces.filter(F.col("total") > piece).select("node", "piece", "ids")
    one = pieces.filter(F.col("total") <= piece).select("node", F.sha2("ids", 256).alias("ends_sha256"))
    streamed = several.repartition("node").sortWithinPartitions("node", "piece").select("node", "ids")
    return one.unionByName(streamed.mapInArrow(_hash_pieces, "node binary, ends_sha256 string"))


def conversation_trie(turns: DataFrame, local: int = LOCAL, piece: int = PIECE) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text)."""
    placed = lineage_cut(placed_turns(turns))
    path = paths(*rebuilt_turns(placed))
    nodes = trie_nodes(path)
    sums = subtree_sums(nodes, path, local)
    ends = end_digests(path.filter("depth = length").select("node", "conv"), piece)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        nodes.join(parents, "parent", "left")
        .join(sums, "node")
        .join(ends, "node", "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            F.col("convs").alias("n_convs"),
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved_below").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
