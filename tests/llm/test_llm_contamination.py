import random
from fractions import Fraction

import pytest

from tests.llm.edges import CLASHES, ROWS, awkward, empty
from trustlake.llm.contamination import contained_items, sketch_size, without_leaks
from trustlake.llm.words import plain_words


def shingles(words, width):
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, items, width=5, threshold=Fraction(8, 10)):
    found = []
    for ident, text in rows:
        words = plain_words((text or "").encode())
        for item, wanted in set(items):
            wanted = plain_words((wanted or "").encode())
            if wanted:
                need = shingles(wanted, min(width, len(wanted)))
                got = need & shingles(words, min(width, len(wanted)))
                if len(got) >= threshold * len(need):
                    found.append((ident, item, len(need), len(got)))
    return sorted(found, key=repr)


ITEMS = [
    (1, "alpha BETA gamma delta epsilon"), (2, None), (3, ""), (4, "one"), (4, "one"), (None, "Zeta, eta; theta!"),
    (5, "dolor sit amet lorem ipsum dolor sit amet"), (6, "nowhere to be found in any text"), (7, "—  ..."),
]


def items_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, item_key string")


def result(frame):
    return sorted(((r.doc_id, r.item_id, r.item_shingles, r.matched) for r in frame.collect()), key=repr)


def test_awkward_rows(spark):
    found = contained_items(awkward(spark), items_frame(spark, ITEMS))
    assert result(found) == brute(ROWS, ITEMS)
    assert contained_items(empty(spark), items_frame(spark, ITEMS)).count() == 0
    assert contained_items(awkward(spark), items_frame(spark, [])).count() == 0


@pytest.mark.parametrize("filter_bits", [24, 7])
def test_partly_held_items(spark, filter_bits):
    """Items with words changed, around the threshold, in texts of very different lengths; a tiny bit set loses nothing."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 80)))) for i in range(40)]
    rows = []
    for n in range(120):
        words = rng.choices(vocabulary, k=rng.choice([5, 200, 3000]))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 2)):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = part
        rows.append((n, " ".join(words)))
    found = contained_items(awkward(spark, rows), items_frame(spark, items), filter_bits=filter_bits)
    assert result(found) == brute(rows, items)


def test_sketches_are_longer_than_what_an_item_may_miss():
    threshold = Fraction(8, 10)
    for n in range(1, 2000):
        missable = max(m for m in range(n) if n - m >= threshold * n)
        assert missable < sketch_size(n, threshold) or sketch_size(n, threshold) == n


def test_documents_without_leaks_stay_whole(spark):
    kept = without_leaks(awkward(spark), items_frame(spark, ITEMS))
    assert kept.columns == ["doc_id", "text", *CLASHES]
    leaking = {(ident, text) for ident, text in ROWS if brute([(ident, text)], ITEMS)}
    clean = [(i, t) for i, t in ROWS if (i, t) not in leaking]
    assert sorted((tuple(r[:2]) for r in kept.collect()), key=repr) == sorted(clean, key=repr)
    assert without_leaks(empty(spark), items_frame(spark, ITEMS)).count() == 0
