"""Keyword rules over free text, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

SUMMARY_CHARS = 200

# Everything Unicode counts as white space, so that tabs, line ends and non-breaking spaces are stripped as well.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(text: Column) -> Column:
    """Text without white space of any kind at either end."""
    return F.trim(text, F.lit(WHITE_SPACE))


def mentions(text: Column, words: Sequence[str]) -> Column:
    """True when any of the words occurs anywhere in the text (substring, so "train" does contain "rain")."""
    return reduce(or_, (F.contains(text, F.lit(w)) for w in words), F.lit(False))


def first_label(text: Column, table: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The label of the first row of ``table`` one of whose words occurs in the text."""
    (label, words), *rest = table
    result = F.when(mentions(text, words), F.lit(label))
    for label, words in rest:
        result = result.when(mentions(text, words), F.lit(label))
    return result.otherwise(F.lit(default))


def first_sentence(text: Column, limit: int = SUMMARY_CHARS) -> Column:
    """Text up to the first full stop, cut to ``limit`` characters."""
    return F.substring(F.split_part(stripped(text), F.lit("."), F.lit(1)), 1, limit)


@dataclass(frozen=True)
class KeywordTable:
    """Configuration of the keyword extractor; all words are lower-case."""

    labels: tuple[tuple[str, tuple[str, ...]], ...]
    high: tuple[str, ...]
    low: tuple[str, ...]
    injury: tuple[str, ...]
    third_party: tuple[str, ...]
    default: str = "other"

    def level(self, text: Column) -> Column:
        ranked = (("high", self.high), ("low", self.low))
        return first_label(text, ranked, "medium")


# The words the insurance keyword rules look for, in the order in which they are tried.
CLAIM_WORDS = KeywordTable(
    labels=(
        ("theft", ("stolen", "broken into", "break-in")),
        ("lost_luggage", ("luggage",)),
        ("travel_disruption", ("cancelled",)),
        ("fire", ("fire",)),
        ("weather", ("storm", "rain")),
        ("water", ("leak", "pipe", "flood")),
        ("collision", ("rear-ended", "collision", "hit", "dented")),
        (
            "medical",
            (
                "doctor",
                "x-ray",
                "physio",
                "dental",
                "tooth",
                "emergency room",
                "specialist",
                "surgery",
                "infection",
            ),
        ),
    ),
    high=("flooded", "coming in", "emergency"),
    low=("cancelled", "consultation", "physiotherapy", "headlight", "windshield"),
    injury=("a fall", "x-ray", "cast", "broken tooth"),
    third_party=("other driver", "neighbour", "stolen", "rear-ended", "break-in", "broken into"),
)

# The closed lists a structured answer must stay within.
DAMAGE_TYPES = (
    "collision",
    "theft",
    "water",
    "fire",
    "weather",
    "lost_luggage",
    "travel_disruption",
    "medical",
    "other",
)
URGENCIES = ("low", "medium", "high")
