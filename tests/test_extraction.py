import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.labelled_cases import CASES, TEMPLATES
from trustlake.functions.keywords import first_sentence
from trustlake.operators.extraction import (
    EXTRACTION,
    FIELDS,
    KEY,
    attach,
    batch_extractor,
    choose_extractor,
    compare_with_labels,
    extract_distinct,
    extraction_accuracy,
    extraction_errors,
    first_valid_answers,
    keyword_extractor,
    read_answers,
    text_key,
    triage,
    with_keyword_fields,
)
from trustlake.operators.rules import FAILED
from trustlake.plans.evaluation import evaluate_extractor, evaluations, log_evaluation


def read(spark, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return with_keyword_fields(frame).orderBy("id").collect()


def test_first_label_wins_and_words_match_anywhere(spark):
    rows = read(spark, "PHONE STOLEN during the trip", "Delayed train", "Something odd happened.", "Pipe leak, flooded")
    assert [r.damage_type for r in rows] == ["theft", "weather", "other", "water"]
    assert [r.urgency for r in rows] == ["medium", "medium", "medium", "high"]
    assert {(r.extractor, r.needs_manual_review) for r in rows} == {("fake", False)}


def test_flags(spark):
    rows = read(spark, "wrist X-ray after a fall", "leak from the neighbour", "nothing")
    assert [(r.injury_mentioned, r.third_party_involved) for r in rows] == [(True, False), (False, True), (False, False)]


def test_summary_is_the_first_sentence_cut(spark):
    texts = ["\n\t One. Two.", "x" * 300, ".", "no stop"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(first_sentence(F.col("t")))
    assert [r[0] for r in frame.collect()] == ["One", "x" * 200, "", "no stop"]


@pytest.fixture
def labelled(spark):
    rows = [(i, t, d, u, h, p, "template" if i < TEMPLATES else "new_text") for i, (t, d, u, h, p) in enumerate(CASES)]
    return spark.createDataFrame(
        rows,
        "id int, text string, damage_type string, urgency string, injury_mentioned boolean, third_party_involved boolean, "
        "group string",
    )


def test_published_accuracy_of_the_keyword_rules(labelled):
    got = with_keyword_fields(labelled.select("id", "text"))
    compared = compare_with_labels(got, labelled, "id", ["group"])
    found = {r.group: r for r in extraction_accuracy(compared, "group").collect()}
    every = extraction_accuracy(compared).first()
    assert every.cases == len(CASES) == 29
    shares = [every[f"accuracy_{f}"] for f in FIELDS]
    assert [round(100 * s) for s in shares] == [83, 76, 97, 93]
    assert round(100 * every.accuracy_all_fields) == 66
    assert round(100 * found["template"].accuracy_all_fields) == 94
    assert round(100 * found["new_text"].accuracy_all_fields) == 18
    assert every.manual_review_rate == 0.0


def test_evaluations_are_recorded(spark, labelled, folder):
    metrics, by_group, compared = evaluate_extractor(labelled, keyword_extractor(), "id")
    assert metrics["accuracy_damage_type"] == 0.8276
    assert {r.group: r.accuracy_all_fields for r in by_group.collect()}["new_text"] == 0.1818
    assert compared.count() == 29
    log_evaluation(spark, folder, "fake", metrics)
    log_evaluation(spark, folder, "again", metrics)
    rows = {r.extractor: r for r in evaluations(spark, folder).collect()}
    assert rows.keys() == {"fake", "again"}
    assert (rows["fake"].cases, rows["fake"].metrics["accuracy_urgency"]) == (29, 0.7586)
    assert rows["fake"].metrics["seconds_per_claim"] >= 0


def test_errors_name_field_expected_and_got(labelled):
    got = with_keyword_fields(labelled.select("id", "text"))
    errors = extraction_errors(compare_with_labels(got, labelled, "id"), "id")
    assert errors.count() == 10
    assert errors.filter("id = 27").first().errors == (
        "damage_type: expected theft, got other; third_party_involved: expected true, got false"
    )


GOOD = {
    "damage_type": "water",
    "urgency": "high",
    "injury_mentioned": False,
    "third_party_involved": False,
    "summary": "A pipe burst.",
}


def answer(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v != "drop"})


@pytest.mark.parametrize(
    ("text", "failed"),
    [
        (answer(), []),
        (answer(extra=1), []),
        (answer(summary="x" * 200), []),
        (answer(injury_mentioned="Yes", third_party_involved=0), []),
        (answer(summary="x" * 201), ["summary_fits"]),
        (answer(damage_type="flooding"), ["damage_type_known"]),
        (answer(urgency="drop"), ["urgency_known"]),
        (answer(damage_type=["water"]), ["damage_type_known"]),
        (answer(injury_mentioned="maybe"), ["injury_present"]),
        (answer(third_party_involved=[True]), ["third_party_present"]),
        (answer(summary=5), ["summary_fits"]),
        ("[1]", ["damage_type_known", "urgency_known", "injury_present", "third_party_present", "summary_fits"]),
    ],
)
def test_answers_by_hand(spark, text, failed):
    row = read_answers(spark.createDataFrame([(text,)], "answer string")).first()
    assert row[FAILED] == failed


@pytest.mark.parametrize("text", ["this is not json", '{"damage_type": "water"', "", None])
def test_unreadable_answers(spark, text):
    row = read_answers(spark.createDataFrame([(text,)], "answer string")).first()
    assert row[FAILED][0] == "answer_is_object"
    assert len(row[FAILED]) == 6


def test_retry_and_fallback(spark):
    bad = answer(damage_type="flooding")
    rows = [
        ("first", 1, answer()),
        ("first", 2, answer(urgency="low")),
        ("second", 1, "junk"),
        ("second", 2, answer(urgency="low")),
        ("wrong", 1, bad),
        ("wrong", 2, bad),
        ("third", 1, "junk"),
        ("third", 2, "junk"),
        ("third", 3, answer()),
    ]
    answers = spark.createDataFrame(rows, f"{KEY} string, attempt int, answer string")
    keys = spark.createDataFrame([("first",), ("second",), ("wrong",), ("third",), ("silent",)], f"{KEY} string")
    found = {r[KEY]: r for r in first_valid_answers(keys, answers, "m").collect()}
    assert {k: r.needs_manual_review for k, r in found.items()} == {
        "first": False,
        "second": False,
        "wrong": True,
        "third": True,
        "silent": True,
    }
    assert (found["first"].urgency, found["second"].urgency) == ("high", "low")
    fallback = found["silent"]
    assert (fallback.damage_type, fallback.urgency, fallback.summary) == ("other", "medium", "Could not be read automatically.")
    assert {r.extractor for r in found.values()} == {"m"}


def counting_extractor(calls):
    plain = keyword_extractor()

    def extract(texts):
        calls.append(texts.count())
        return plain(texts)

    return extract


def test_every_distinct_text_is_read_once(spark):
    texts = ["Burst pipe.", "  Burst pipe.\n", "Burst pipe."] * 50 + ["Stolen phone."]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    calls = []
    readings, cache = extract_distinct(frame, "text", counting_extractor(calls))
    assert calls == [2]
    assert attach(frame, "text", readings).filter("damage_type = 'water'").count() == 150
    again, fresh = extract_distinct(frame, "text", counting_extractor(calls), cache)
    assert calls == [2, 0]
    assert (again.count(), fresh.count()) == (2, 0)


def test_fallbacks_are_not_remembered(spark):
    frame = spark.createDataFrame([("Burst pipe.",)], "text string")

    def nothing(texts):
        return first_valid_answers(texts, spark.createDataFrame([], f"{KEY} string, attempt int, answer string"), "m")

    readings, cache = extract_distinct(frame, "text", nothing)
    assert readings.first().needs_manual_review
    assert cache.count() == 0


def test_a_users_reader_is_checked_told_and_replaced(spark, tmp_path):
    """Valid at once, valid when told what was wrong, never valid, skipped, and a reader that raises."""
    right, late, vague, long = answer(), answer(urgency="low"), answer(urgency="drop"), answer(summary="x" * 500)
    folder = str(tmp_path)

    def read_batch(texts: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for key, text, error in zip(texts[KEY], texts["text"], texts["last_error"], strict=True):
            again = isinstance(error, str)
            with open(f"{folder}/{text}-{int(again)}", "w") as file:
                file.write(str(error))
            if text == "told":
                rows.append((key, late if again else vague))
            elif text == "never":
                rows.append((key, long))
            elif text == "good":
                rows.append((key, right))
        return pd.DataFrame(rows, columns=[KEY, "answer"])

    frame = spark.createDataFrame([("good",), ("told",), ("never",), ("skipped",)], "text string")
    readings, cache = extract_distinct(frame, "text", batch_extractor("r", read_batch))
    assert readings.columns == [KEY, *EXTRACTION]
    found = {r.text: r for r in attach(frame, "text", readings).collect()}
    assert {t: (r.urgency, r.needs_manual_review) for t, r in found.items()} == {
        "good": ("high", False), "told": ("low", False), "never": ("medium", True), "skipped": ("medium", True)}
    assert {r.extractor for r in found.values()} == {"r"} and cache.count() == 2
    told = {f.name.split("-")[0]: f.read_text() for f in tmp_path.iterdir() if f.name.endswith("-1")}
    assert told.keys() == {"told", "never", "skipped"}
    assert told["told"] == "urgency_known" and told["never"] == "summary_fits"


def test_a_reader_that_raises_leaves_its_texts_to_people(spark):
    right = answer()

    def broken(texts: pd.DataFrame) -> pd.DataFrame:
        if texts["last_error"].isna().any():
            raise ValueError("no connection")
        assert set(texts["last_error"]) == {"ValueError: no connection"}
        return pd.DataFrame({KEY: texts[KEY], "answer": right})

    frame = spark.createDataFrame([("a",), ("b",)], "text string")
    readings, _ = extract_distinct(frame, "text", batch_extractor("r", broken))
    assert {r.needs_manual_review for r in readings.collect()} == {False}
    readings, _ = extract_distinct(frame, "text", batch_extractor("r", broken, attempts=1))
    assert {(r.needs_manual_review, r.damage_type) for r in readings.collect()} == {(True, "other")}


def test_settings_choose_the_extractor(spark):
    texts = spark.createDataFrame([("k", "fire")], f"{KEY} string, text string")
    assert choose_extractor({})(texts).first().extractor == "fake"
    assert choose_extractor({"model": "m"})(texts).first().extractor == "fake"

    def read_batch(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({KEY: frame[KEY], "answer": None})

    assert choose_extractor({"model": "m"}, read_batch)(texts).first().extractor == "llm:m"


def test_a_case_nobody_has_read_is_wrong(spark):
    fields = "damage_type string, urgency string, injury_mentioned boolean, third_party_involved boolean"
    labels = spark.createDataFrame([(1, "all", "water", "high", False, None), (2, "g", "fire", "low", True, False)], f"id int, g string, {fields}")
    got = spark.createDataFrame([(1, "water", "high", False, None, False)], f"id int, {fields}, needs_manual_review boolean")
    compared = compare_with_labels(got, labels, "id", ["g"])
    total = extraction_accuracy(compared).first()
    assert (total.cases, total.accuracy_all_fields, total.manual_review_rate) == (2, 0.5, 0.5)
    # a group may be called all
    assert {r.g: r.accuracy_all_fields for r in extraction_accuracy(compared, "g").collect()} == {"all": 1.0, "g": 0.0}
    assert [r.id for r in extraction_errors(compared, "id").collect()] == [2]


def test_triage_keeps_a_score_without_extraction(spark):
    scored = spark.createDataFrame([("C1", 0.5), ("C2", 0.6)], "claim_id string, fraud_score double")
    described = spark.createDataFrame([("C1", "Stolen phone")], "claim_id string, text string")
    rows = {r.claim_id: r for r in triage(scored, with_keyword_fields(described)).collect()}
    assert rows["C1"].note.startswith("No LLM configured")
    assert (rows["C2"].fraud_score, rows["C2"].damage_type, rows["C2"].note) == (0.6, None, None)


def test_text_key_ignores_outer_white_space(spark):
    frame = spark.createDataFrame([(" a ",), ("a",), ("a b",)], "t string")
    keys = [r[0] for r in frame.select(text_key("t")).collect()]
    assert keys[0] == keys[1] != keys[2]
