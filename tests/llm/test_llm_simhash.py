import random
import re

import xxhash

from tests.llm.edges import CLASHES, ROWS, awkward, empty
from trustlake.llm.components import components
from trustlake.llm.masks import covering_masks, free_bits, signed
from trustlake.llm.simhash import near_groups, near_links, one_per_group


def brute_print(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    size = min(shingle, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + size]).encode(), seed=42).intdigest() for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints, radius=2):
    """The least member (as a signed number) of each print's component."""
    left, root = set(prints), {}
    while left:
        seed = left.pop()
        group, reached = {seed}, [seed]
        while reached:
            now = reached.pop()
            near = {p for p in left if (p ^ now).bit_count() <= radius}
            left -= near
            group |= near
            reached += near
        least = min(map(signed, group))
        root |= {p: least for p in group}
    return root


def test_masks_cover_every_pair_of_bits():
    for bits in (range(64), free_bits(covering_masks(range(64), 2)[0], range(64))):
        masks = covering_masks(bits, 2)
        assert len(masks) == 7
        for a in bits:
            for b in bits:
                assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_second_level_buckets_are_bounded():
    for mask in covering_masks(range(64), 2):
        free = free_bits(mask, range(64))
        assert max(len(free_bits(m, free)) for m in covering_masks(free, 2)) <= 12


def prints_with_neighbours(seed=1, groups=30, size=40):
    rng = random.Random(seed)
    prints = set()
    for _ in range(groups):
        now = rng.getrandbits(64)
        for _ in range(rng.randint(1, size)):
            prints.add(now)
            for _ in range(rng.randint(1, 3)):
                now ^= 1 << rng.randrange(64)
    return prints


def test_links_and_components_lose_nothing(spark):
    near = random.Random(2).getrandbits(64)
    # many prints that agree in most bits, so that buckets overflow
    crowd = {near ^ sum(1 << b for b in random.Random(i).sample(range(0, 64, 3), 4)) for i in range(400)}
    for prints, bucket in ((prints_with_neighbours(), 2048), (prints_with_neighbours(3) | crowd, 8)):
        frame = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
        found = {r.node: r.root for r in components(near_links(frame, 2, bucket)).collect()}
        expected = brute_roots(prints)
        assert {signed(p): found.get(signed(p), signed(p)) for p in prints} == {signed(p): r for p, r in expected.items()}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 1999)], "a bigint, b bigint")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 0 for i in range(301)} | {1999: 1999, 2000: 1999}
    assert components(edges.filter("a < 0")).count() == 0


def expected_groups(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_roots(set(prints))
    least = {}
    for (ident, _), p in zip(rows, prints, strict=True):
        if ident is not None:
            least[roots[p]] = min(ident, least.get(roots[p], ident))
    return [(i, format(p, "016x"), least.get(roots[p])) for (i, _), p in zip(rows, prints, strict=True)]


def test_awkward_rows(spark):
    found = [tuple(r) for r in near_groups(awkward(spark)).collect()]
    assert sorted(found, key=repr) == sorted(expected_groups(ROWS), key=repr)
    assert near_groups(empty(spark)).count() == 0


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = [tuple(r) for r in near_groups(docs).collect()]
    assert sorted(found) == sorted(expected_groups(rows))


def test_one_document_of_each_group_stays(spark):
    kept = one_per_group(awkward(spark))
    assert kept.columns == ["doc_id", "text", *CLASHES]
    roots = brute_roots({brute_print(t) for _, t in ROWS})
    groups = {}
    for ident, text in ROWS:
        groups.setdefault(roots[brute_print(text)], []).append(ident)
    assert kept.count() == len(groups)
    leads = sorted((min((i for i in ids if i is not None), default=None) for ids in groups.values()), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == leads
    assert one_per_group(empty(spark)).count() == 0


def test_repeated_rows_leave_one(spark):
    rows = [(5, "same text of several words")] * 4 + [(None, "no id at all here")] * 3
    assert sorted((tuple(r[:2]) for r in one_per_group(awkward(spark, rows)).collect()), key=repr) == [rows[0], rows[-1]]
