import re
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from tests.llm.edges import CLASHES, ROWS, awkward, empty, plain
from trustlake.llm.exact_dedup import classify, without_copies


def brute(rows):
    """keep_id, group_size and kept per row, by the definition."""
    groups = defaultdict(list)
    for ident, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", text or "")].append((ident, text or ""))
    found = []
    for content, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        digest = sha256(content.encode()).hexdigest()
        found += [(i, best[0], len(members), (i, len(t)) == (best[0], len(best[1])), digest) for i, t in members]
    return plain(found)


def test_awkward_rows(spark):
    assert plain(classify(awkward(spark)).collect()) == brute(ROWS)
    assert classify(empty(spark)).count() == 0


def test_a_digest_with_several_contents(spark):
    """Contents are compared in full: a digest of one hex digit gives the same groups."""
    rows = [(i, f"text {i % 40}" + " " * (i % 3)) for i in range(200)]
    weak = classify(awkward(spark, rows), digest=lambda c: F.substring(F.sha2(c, 256), 1, 1))
    assert plain(weak.collect()) == brute(rows)


def test_one_row_of_each_group_stays_whole(spark):
    kept = without_copies(awkward(spark))
    assert kept.columns == ["doc_id", "text", *CLASHES]
    groups = {re.sub(r"\s+", "", t or "") for _, t in ROWS}
    assert kept.count() == len(groups)
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(i, t) for i, t in ROWS if (i, t) in {
        (6, ROWS[8][1]), (4, ROWS[3][1]), (-3, "one"), (7, ROWS[9][1]), (9, ROWS[11][1]), (5, "two")}}
    assert without_copies(empty(spark)).count() == 0


def test_repeated_rows_leave_one(spark):
    rows = [(5, "same text")] * 4 + [(None, "no id")] * 3 + [(1, "a b"), (1, "ab ")]
    kept = [tuple(r[:2]) for r in without_copies(awkward(spark, rows)).collect()]
    assert len(kept) == 3
    assert {k for k in kept if k[0] != 1} == {(5, "same text"), (None, "no id")}


def test_ids_at_the_ends_of_their_range(spark):
    rows = [(2**63 - 1, "x y"), (-(2**63), "x y"), (0, "xy"), (None, "x  y")]
    assert plain(classify(awkward(spark, rows)).collect()) == brute(rows)
