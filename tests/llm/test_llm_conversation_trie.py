import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from trustlake.llm.conversation_trie import (
    centroid_sums,
    conversation_trie,
    end_digests,
    paths,
    placed_turns,
    rebuilt_turns,
    subtree_sums,
    trie_nodes,
)

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, conv string, depth int, top string"


def brute(rows):
    """The trie by lists of turns."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own[c])] for c in own}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    found = []
    for node, convs in members.items():
        subtree = [n for n in members if n[: len(node)] == node]
        children = [n for n in subtree if len(n) == len(node) + 1]
        leaves = sum(not any(m[:-1] == n for m in members if m) for n in subtree)
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in subtree if n)
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        found.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), leaves, saved,
                      sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "c", 7, "t") for r in rows], SCHEMA)


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def chats(seed, convs, longest=6, words=2):
    dice = random.Random(seed)
    return [
        (c, t, dice.choice(["user", None, "assistant"][: 1 + t % 3]), dice.choice(["é", "", None, "b" * 9][: words + 1]))
        for c in range(convs)
        for t in range(dice.randrange(1, longest))
    ]


@pytest.mark.parametrize("local", [1, 7, 4096])
def test_every_split_gives_the_trie(spark, local):
    """With one node a task all splitting is done by joins, with many all of it in one task."""
    rows = chats(local, 60)
    assert result(conversation_trie(frame(spark, rows), local=local, piece=3)) == brute(rows)


def test_awkward_turns(spark):
    rows = [
        (10, None, "user", "first"), (10, 1, None, None), (10, 1, "user", "b"), (10, 1, "user", "b"), (10, 1, "user", "a"),
        (11, 5, "", ""), (None, 1, "user", "nobody"), (7, 1, "user", "no head"), (7, 2, "user", "x" * 200_000),
        (13, 0, None, None), (14, 0, "user", "first"), (15, 0, "user", "ß日本"), (2**62, 0, "a|b", "c"), (2**62 + 1, 0, "a", "b|c"),
    ]
    got = result(conversation_trie(frame(spark, rows), local=2))
    # turns of one number and role are in order of their digests
    order = {t: sha256(f"{len('user')}|user|{t}".encode()).hexdigest() for t in "ab"}
    fixed = [(*r[:2], r[2], r[3]) if r[3] not in order or r[1] != 1 else (r[0], 1, r[2], r[3]) for r in rows]
    if order["a"] > order["b"]:
        fixed = [(c, 2 if (c, t, x) == (10, 1, "a") else t, r, x) for c, t, r, x in fixed]
    assert got == brute(fixed)
    assert conversation_trie(frame(spark, [])).count() == 0
    assert conversation_trie(frame(spark, [(None, 1, "a", "b")])).count() == 0


def test_a_long_conversation_and_a_hot_one(spark):
    rows = [(5, t, "user", f"turn {t % 7}") for t in range(300)]
    rows += [(c, t, "user", f"turn {t % 7}") for c in range(20, 200, 5) for t in range(9)]
    placed = placed_turns(frame(spark, rows).repartition(3))
    assert placed.filter("conv = 5").count() == 300
    path = paths(*rebuilt_turns(placed))
    nodes = trie_nodes(path)
    # a chain of 300 nodes, no task with more than 8
    sums = {bytes(r.node): r.leaves for r in subtree_sums(nodes, path, local=8).collect()}
    depth = {bytes(r.node): (r.depth, r.weight) for r in nodes.collect()}
    assert len(sums) == 301 and set(sums.values()) == {1}
    assert all(weight == 301 - d for d, weight in depth.values())


def test_ends_are_hashed_in_pieces(spark):
    ids = [*range(-50, 950), 2**60]
    ends = spark.createDataFrame([(b"n", i) for i in ids] + [(b"m", 3)], "node binary, conv bigint").repartition(7)
    got = {bytes(r.node): r.ends_sha256 for r in end_digests(ends, piece=64).collect()}
    assert got == {b"n": sha256(",".join(map(str, ids)).encode()).hexdigest(), b"m": sha256(b"3").hexdigest()}


@pytest.mark.parametrize("seed", range(20))
def test_sums_of_one_task(seed):
    dice = random.Random(seed)
    count = dice.randrange(1, 60)
    kind = [lambda n: n - 1, lambda n: dice.randrange(-1, n), lambda n: 0, lambda n: max(-1, n - dice.randrange(1, 3))][seed % 4]
    parents = [-1, *(kind(n) for n in range(1, count))]
    values = [[dice.randrange(9) for _ in range(count)]]

    def total(node):
        return values[0][node] + sum(total(c) for c in range(count) if parents[c] == node)

    assert centroid_sums(parents, values) == [[total(n) for n in range(count)]]


def test_subtree_sizes(spark):
    path = paths(*rebuilt_turns(placed_turns(frame(spark, chats(3, 40, 8, 1)))))
    nodes = {bytes(r.node): r for r in trie_nodes(path).collect()}

    def size(name):
        return 1 + sum(size(n) for n, r in nodes.items() if r.parent is not None and bytes(r.parent) == name)

    assert all(r.weight == size(n) for n, r in nodes.items())
