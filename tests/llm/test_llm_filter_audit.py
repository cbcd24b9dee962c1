import re
from collections import Counter
from itertools import permutations

import pytest

from tests.llm.edges import ROWS, awkward, empty
from trustlake.llm.filter_audit import FILTERS, audit_filters, failures

GOOD = "word " * 3 + " ".join(f"w{i}" for i in range(230))
TEXTS = [
    (1, GOOD, "a"),
    (2, GOOD, "a"),
    (2, GOOD, "a"),
    (None, GOOD, "b"),
    (3, GOOD + " ", "b"),
    (4, None, None),
    (5, "", ""),
    (6, "SHOUT # " * 300, "a"),
    (0, "few #words", "b"),
    (7, "few #words", "a"),
    (7, "few #words", "b"),
    (8, "É" * 98 + "AB", "a"),
    (9, "É" * 97 + "ABC", "a"),
    (10, " ".join(f"w{i}" for i in range(200)), "c"),
    (11, " ".join(f"w{i}" for i in range(100)) + " w1" * 100, "c"),
    (12, " ".join(f"w{i}" for i in range(99)) + " w1" * 101, "c"),
    (13, "x y z\x1cq", "c"),
]


def brute(rows, stated):
    """Every order applied filter by filter, document by document."""
    found = {}
    docs = []
    for ident, text, part in rows:
        text, part = text or "", part or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": ident is not None and any(i is not None and i < ident and (t or "") == text for i, t, _ in rows),
        }
        docs.append((part, {f for f, bad in fails.items() if bad}, *stated.get(ident, (0, 0))))
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = Counter()
        for order in permutations(FILTERS):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [d for d in left if letter in d[1]]
                earlier = [d for d in own if not any(d is k for k in left)]
                left = [d for d in left if letter not in d[1]]
                shapley[letter] += len(removed)
                found[part, "".join(order), step] = (
                    len(left),
                    len(removed),
                    sum(letter in d[1] for d in earlier),
                    sum(d[1] == {letter} for d in own),
                    sum(d[2] for d in removed),
                    sum(d[3] for d in removed),
                )
        for key in [k for k in found if k[0] == part]:
            found[key] += (shapley[key[1][key[2] - 1]],)
    return found


def rows_of(frame):
    return {
        (r.part, r.filter_order, r.step): (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley
        )
        for r in frame.collect()
    }


@pytest.fixture
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (2, 1, None), (6, 1, 1), (None, 1, 1), (7, 0, 0), (99, 1, 1), (9, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


STATED = {1: (1, 0), 2: (1, 1), 6: (1, 1), 7: (0, 0), 9: (1, 0)}


def test_every_order_against_the_definition(spark, labels):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string, source string")
    found = rows_of(audit_filters(docs, labels))
    assert found == brute(TEXTS, STATED)
    assert len(found) == 600 * 4


def test_awkward_documents_and_columns_of_the_same_names(spark, labels):
    docs = awkward(spark).withColumnRenamed("Text_", "source")
    assert rows_of(audit_filters(docs, labels)) == brute([(i, t, "T") for i, t in ROWS], STATED)
    assert audit_filters(empty(spark).withColumnRenamed("Text_", "source"), labels).count() == 0
    assert audit_filters(docs, labels.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_a_group_of_copies_never_pairs_up(spark):
    """A third of all rows are one text: the semi-join meets one row a text, and no row is lost."""
    rows = [(i, GOOD if i % 3 == 0 else f"{GOOD} {i}", "p") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    failed = failures(docs).groupBy("fails").sum("documents").collect()
    assert {r[0]: r[1] for r in failed} == {0: 601, 16: 299}
