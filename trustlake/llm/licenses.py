"""License scans: ordered signature rules over a text's words, gated by keywords, overlaps resolved by priority.

A text becomes its words (runs of digits, ASCII letters lower-cased, non-ASCII characters). Rules of whose gate words one occurs
are matched; a detection lying within a kept one of higher priority, or of equal priority and greater length, is suppressed.
Detections of base rules always stay. The score is the chance that any kept label holds, if each rule's weight is the chance
that its label does.

Defined results: a null text is empty; no words, no detections, score 0. Ties between detections of equal place and priority
go to the earlier rule, labels differing or not. Repeated rows give repeated rows. An empty table gives an empty table. Other
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.frames import byte_texts, in_slices, record
from trustlake.llm.license_rules import RULES, Rule
from trustlake.llm.words import plain_words

SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, detections array<struct<label: string, first: bigint, last: bigint, priority: int>>"
)


class Detection(NamedTuple):
    start: int
    end: int
    rule: int


def matches(words: list[bytes], rules: Sequence[Rule], by_gate: dict[bytes, list[int]]) -> list[Detection]:
    """All places where a rule holds, in words."""
    gates = by_gate.keys() & set(words)
    if not gates:
        return []
    line = b" ".join(words)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    found = []
    for number in sorted({n for gate in gates for n in by_gate[gate]}):
        for match in rules[number].pattern.finditer(line):
            found.append(Detection(bisect_left(starts, match.start()), bisect_left(starts, match.end()), number))
    return found


class Reach:
    """How far the intervals added so far reach that begin at or before a place (a prefix-maximum tree)."""

    def __init__(self, places: list[int]) -> None:
        self.places = sorted(set(places))
        self.ends = [0] * (len(self.places) + 1)

    def add(self, start: int, end: int) -> None:
        node = bisect_left(self.places, start) + 1
        while node < len(self.ends):
            self.ends[node] = max(self.ends[node], end)
            node += node & -node

    def covers(self, start: int, end: int) -> bool:
        node = bisect_left(self.places, start) + 1
        while node:
            if self.ends[node] >= end:
                return True
            node &= node - 1
        return False


def resolved(found: list[Detection], rules: Sequence[Rule]) -> list[Detection]:
    """Detections that no stronger one contains, and all of base rules."""
    kept: list[Detection] = []
    reach = Reach([d.start for d in found])
    for d in sorted(found, key=lambda d: (-rules[d.rule].priority, d.start - d.end, d.start, d.rule)):
        if rules[d.rule].base or not reach.covers(d.start, d.end):
            kept.append(d)
            reach.add(d.start, d.end)
    return sorted(kept)


def gates_of(rules: Sequence[Rule]) -> dict[bytes, list[int]]:
    by_gate = defaultdict(list)
    for number, rule in enumerate(rules):
        for gate in rule.gates:
            by_gate[gate].append(number)
    return dict(by_gate)


def scan_text(text: bytes, rules: Sequence[Rule], by_gate: dict[bytes, list[int]]) -> tuple:
    """The columns of ``SCHEMA`` after the id."""
    words = plain_words(text)
    kept = resolved(matches(words, rules, by_gate), rules)
    base = [d for d in kept if rules[d.rule].base]
    weight: dict[str, float] = {}
    for d in kept:
        rule = rules[d.rule]
        weight[rule.label] = max(weight.get(rule.label, 0.0), rule.weight)
    none = 1.0
    for label in sorted(weight):
        none *= 1 - weight[label]
    starts = [d.start for d in base]
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({rules[d.rule].label for d in base})),
        ",".join(sorted(weight)),
        1 - none,
        [{"label": rules[d.rule].label, "first": d.start, "last": d.end - 1, "priority": rules[d.rule].priority} for d in kept],
    )


def scan_licenses(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """A row per document: counts and places of base phrases, labels, score and all kept detections."""
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text")
    )
    by_gate = gates_of(rules)
    detection = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("priority", pa.int32())])
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(detection)]
    names = [part.split(":")[0].split()[0] for part in SCHEMA.split(", ")[:9]]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [scan_text(text, rules, by_gate) for text in byte_texts(batch["text"])]
            yield record(schema, batch["doc_id"], *zip(*found, strict=True))

    return rows.mapInArrow(scan, SCHEMA)
