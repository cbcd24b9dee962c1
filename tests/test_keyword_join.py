"""A table of keywords must answer as the expression over a list does."""

import random

import pytest
from pyspark.sql import functions as F

from trustlake.functions.keywords import CLAIM_WORDS, first_label
from trustlake.operators import keyword_join
from trustlake.operators.keyword_join import GROUP, keyword_index, with_first_label

WORDS = "word string, label string, rank int"


def labels(frame):
    return {r["id"]: r["label"] for r in frame.collect()}


def test_same_as_the_expression(spark):
    table = [(w, label, rank) for rank, (label, words) in enumerate(CLAIM_WORDS.labels) for w in words]
    texts = ["The train was late", "STOLEN luggage", "a pipe leak and a fire", "", None, "hit", "nothing", "x-ray by a doctor"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    plain = frame.select("id", first_label(F.lower(F.coalesce("text", F.lit(""))), CLAIM_WORDS.labels, "other").alias("label"))
    found = with_first_label(frame, spark.createDataFrame(table, WORDS))
    assert labels(found) == labels(plain)
    assert labels(found)[0] == "weather"


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, seed):
    dice = random.Random(seed)
    letters = "abßé😀 \n"
    words = [("".join(dice.choices(letters, k=dice.randint(1, 7))), dice.choice("LMN"), dice.randint(0, 5)) for _ in range(60)]
    texts = ["".join(dice.choices(letters, k=dice.randint(0, 30))) for _ in range(80)]
    found = with_first_label(
        spark.createDataFrame(list(enumerate(texts)), "id int, text string"), spark.createDataFrame(words, WORDS)
    )
    for number, label in labels(found).items():
        hits = sorted((rank, label) for word, label, rank in words if word in texts[number])
        assert label == (hits[0][1] if hits else "other"), texts[number]


def test_ties_repeats_and_unusable_words(spark):
    words = [("fire", "b", 1), ("fire", "a", 1), ("fire", "z", 0), ("", "all", 0), (None, "all", 0), ("smoke", "s", None)]
    frame = spark.createDataFrame([(1, "fire!", "old"), (1, "fire!", "old"), (2, "smoke", None)], "id int, text string, label string")
    found = with_first_label(frame, spark.createDataFrame(words, WORDS))
    assert found.columns == ["id", "text", "label"]
    assert sorted(r["label"] for r in found.collect()) == ["other", "z", "z"]
    assert labels(with_first_label(frame, spark.createDataFrame([], WORDS))) == {1: "other", 2: "other"}
    assert with_first_label(frame.limit(0), spark.createDataFrame(words, WORDS)).count() == 0
    with pytest.raises(ValueError, match="own"):
        with_first_label(frame, spark.createDataFrame(words, WORDS), label="text")


def test_every_word_stands_once_under_its_rarest_group(spark):
    words = [("storm", "s", 0), ("storms", "s", 1), ("rain", "r", 2), ("ab", "t", 3)]
    index = {r["word"]: (r["group"], r["size"]) for r in keyword_index(spark.createDataFrame(words, WORDS)).collect()}
    assert index["storms"] == ("orms", GROUP)
    assert index["ab"] == ("ab", 2) and index["rain"] == ("rain", GROUP)


def test_a_long_text_and_many_words(spark):
    """One pass over the text, whatever the number of words."""
    words = spark.range(20_000).select(
        F.format_string("w%05d", "id").alias("word"), F.col("id").cast("string").alias("label"), F.col("id").cast("int").alias("rank")
    )
    text = "lorem ipsum " * 100_000 + "w19999 w12345"
    found = with_first_label(spark.createDataFrame([(1, text)], "id int, text string"), words)
    assert labels(found) == {1: "12345"}


def test_candidates_of_a_text_come_in_chunks(spark, monkeypatch):
    """However many words may be in a text, they do not meet it in one row; the first in order is found in any chunk."""
    monkeypatch.setattr(keyword_join, "CHUNK", 3)
    words = [(f"word{n}", None if n == 7 else f"label{n}", 9 - n) for n in range(10)]
    texts = [(n, f"a word{n} and a word0") for n in range(10)] + [(10, "wor d")]
    found = labels(with_first_label(spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(words, WORDS)))
    assert found == {n: None if n == 7 else f"label{n}" for n in range(10)} | {10: "other"}
