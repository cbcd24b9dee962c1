"""Structured fields from the documents' whole texts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.functions.hashing import chosen, keyed_hash
from trustlake.functions.keywords import DAMAGE_TYPES, SUMMARY_CHARS, URGENCIES, WHITE_SPACE, KeywordTable, first_sentence
from trustlake.operators.extraction import (
    EXTRACTION,
    FALSE_TEXTS,
    FIELDS,
    KEY,
    KEYWORD_NOTE,
    TRUE_TEXTS,
    UNREADABLE_SUMMARY,
    attach,
    batch_extractor,
    compare_with_labels,
    extract_distinct,
    extract_rows,
    extraction_accuracy,
    extraction_errors,
    first_valid_answers,
    keyword_extractor,
    read_answers,
    triage,
    with_keyword_fields,
)
from trustlake.operators.keyword_join import with_first_label
from trustlake.operators.rules import member_of
from trustlake.operators.scoring import score_batch
from trustlake.queries.bindings import hit_sql, stored_feeds, table
from trustlake.queries.catalogue import query
from trustlake.queries.modelling import ACCEPTED, scorer
from trustlake.queries.quality import reasons, requests
from trustlake.session import lineage_cut
from trustlake.sources.logs import extraction_log

# words that occur in the given documents, in the role of the claim words
WORDS = KeywordTable(
    labels=(
        ("theft", ("license", "copyright")),
        ("lost_luggage", ("@", "http")),
        ("fire", ("token", "password", "secret")),
        ("weather", ("eaux", "ê")),
        ("water", ("ción", "ñ")),
        ("collision", ("schl", "ung ")),
        ("medical", ("hedin", "oresh", "reti")),
    ),
    high=("***", "%%%", "###"),
    low=("ation", "ement"),
    injury=("an the", "le la", "der die"),
    third_party=("erre", "ouou"),
)


def any_sql(words: tuple[str, ...], text: str = "t") -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def keyword_sql(words: KeywordTable, source: str, keep: str) -> str:
    """SELECT of the keyword fields; ``source`` has a column ``text``."""
    labels = " ".join(f"WHEN {any_sql(w)} THEN '{label}'" for label, w in words.labels)
    return f"""SELECT {keep}, CASE {labels} ELSE '{words.default}' END AS damage_type,
      CASE WHEN {any_sql(words.high)} THEN 'high' WHEN {any_sql(words.low)} THEN 'low' ELSE 'medium' END AS urgency,
      {any_sql(words.injury)} AS injury_mentioned, {any_sql(words.third_party)} AS third_party_involved,
      substring(split_part(trim(text, '{WHITE_SPACE}'), '.', 1), 1, {SUMMARY_CHARS}) AS summary, 'fake' AS extractor,
      false AS needs_manual_review
    FROM (SELECT *, lower(text) AS t FROM {source})"""


READ = f"found AS ({keyword_sql(WORDS, 'documents', 'doc_id, lang, text')})"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "text")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_keyword_fields(documents(spark, sf_dir), "text", WORDS)


@query("x1_first_match", f"WITH {READ} SELECT doc_id, damage_type FROM found")
def x1_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir).select("doc_id", "damage_type")


@query("x2_urgency", f"WITH {READ} SELECT doc_id, urgency FROM found")
def x2_urgency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir).select("doc_id", "urgency")


@query("x3_flags", f"WITH {READ} SELECT doc_id, injury_mentioned, third_party_involved FROM found")
def x3_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir).select("doc_id", "injury_mentioned", "third_party_involved")


@query(
    "x1_keyword_table",
    """WITH words AS (
      SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM benchmark),
    texts AS (SELECT doc_id, lower(text) AS t FROM documents),
    hits AS (SELECT doc_id, first(word ORDER BY -length(word), word) AS label FROM texts, words
             WHERE length(word) > 4 AND contains(t, word) GROUP BY doc_id)
    SELECT doc_id, coalesce(label, 'other') AS label FROM documents LEFT JOIN hits USING (doc_id)""",
)
def x1_keyword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest word of the benchmark that occurs anywhere in a document: keywords that are a table."""
    word = F.explode(F.split(F.lower("text"), " ")).alias("word")
    words = table(spark, sf_dir, "benchmark").select(word).filter("length(word) > 4")
    ranked = words.select("word", F.col("word").alias("label"), (-F.length("word")).alias("rank"))
    return with_first_label(table(spark, sf_dir, "documents"), ranked).select("doc_id", "label")


@query("x4_summary", f"WITH {READ} SELECT doc_id, summary FROM found")
def x4_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", first_sentence(F.col("text")).alias("summary"))


# --- answers -----------------------------------------------------------------------------------------------------

# How the first hex digit of the hash spoils an answer; with any other digit it is right.
WRONG_SHAPES = {
    "4": "not JSON at all",
    "5": "a damage type outside the list",
    "6": "no urgency",
    "7": "yes instead of true, which is accepted",
    "8": "the whole text as summary, mostly too long",
    "9": "no answer",
    "a": "cut off in the middle",
}


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three recorded answers per document, some of them wrong in one of the ways listed in ``WRONG_SHAPES``."""
    attempts = documents(spark, sf_dir).select("doc_id", "text", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("attempt"))
    shaped = attempts.withColumn("shape", F.substring(keyed_hash("answer", "doc_id", "attempt"), 1, 1))
    shape = F.col("shape")
    damage = F.when(shape == "5", F.lit("flooding")).otherwise(F.lit("water")).alias("damage_type")
    urgency = F.when(shape != "6", F.lit("high")).alias("urgency")
    summary = F.when(shape == "8", F.col("text")).otherwise(first_sentence(F.col("text"))).alias("summary")
    hurt = (F.col("attempt") == 1).alias("injury_mentioned")
    other = F.lit(False).alias("third_party_involved")
    usual = F.to_json(F.struct(damage, urgency, hurt, other, summary))
    worded = F.to_json(F.struct(damage, urgency, F.lit("yes").alias("injury_mentioned"), other, summary))
    answer = (
        F.when(shape == "4", F.lit("this is not json"))
        .when(shape == "9", F.lit(None))
        .when(shape == "a", F.lit('{"damage_type": "water"'))
        .when(shape == "7", worded)
        .otherwise(usual)
    )
    return shaped.select("doc_id", "attempt", answer.alias("answer"))


def truth_sql(name: str) -> str:
    value = f"lower(json_extract_string(j, '$.{name}'))"
    return (
        f"CASE WHEN {member_of(value, TRUE_TEXTS)} THEN true WHEN {member_of(value, FALSE_TEXTS)} THEN false END AS {name}"
    )


def json_text_sql(name: str) -> str:
    return f"CASE WHEN json_type(j, '$.{name}') = 'VARCHAR' THEN json_extract_string(j, '$.{name}') END AS {name}"


ANSWERS = f"""shaped AS (
  SELECT doc_id, text, substring(split_part(trim(text, '{WHITE_SPACE}'), '.', 1), 1, {SUMMARY_CHARS}) AS sentence,
         attempt, substr(md5('answer|' || doc_id || '|' || attempt), 1, 1) AS shape
  FROM documents, (VALUES (1), (2), (3)) a(attempt)),
answers AS (SELECT doc_id, attempt, CASE shape WHEN '4' THEN 'this is not json' WHEN '9' THEN NULL
    WHEN 'a' THEN '{{"damage_type": "water"'
    WHEN '7' THEN CAST(json_object('damage_type', 'water', 'urgency', 'high', 'injury_mentioned', 'yes',
      'third_party_involved', false, 'summary', sentence) AS VARCHAR)
    ELSE CAST(json_object('damage_type', CASE WHEN shape = '5' THEN 'flooding' ELSE 'water' END,
      'urgency', CASE WHEN shape <> '6' THEN 'high' END, 'injury_mentioned', attempt = 1, 'third_party_involved', false,
      'summary', CASE WHEN shape = '8' THEN text ELSE sentence END) AS VARCHAR) END AS answer FROM shaped),
parsed AS (SELECT doc_id, attempt, CASE WHEN json_valid(answer) THEN CAST(answer AS JSON) END AS j FROM answers),
fields AS (SELECT doc_id, attempt, j, {json_text_sql("damage_type")}, {json_text_sql("urgency")},
  {truth_sql("injury_mentioned")}, {truth_sql("third_party_involved")}, {json_text_sql("summary")} FROM parsed),
judged AS (SELECT *, concat_ws(',', CASE WHEN j IS NULL THEN 'answer_is_object' END,
  CASE WHEN NOT coalesce({member_of("damage_type", DAMAGE_TYPES)}, false) THEN 'damage_type_known' END,
  CASE WHEN NOT coalesce({member_of("urgency", URGENCIES)}, false) THEN 'urgency_known' END,
  CASE WHEN injury_mentioned IS NULL THEN 'injury_present' END,
  CASE WHEN third_party_involved IS NULL THEN 'third_party_present' END,
  CASE WHEN NOT coalesce(length(summary) <= {SUMMARY_CHARS}, false) THEN 'summary_fits' END) AS failed_rules FROM fields)"""
ANSWER_FIELDS = "damage_type, urgency, injury_mentioned, third_party_involved, summary"


@query("x5_validate_answer", f"WITH {ANSWERS} SELECT doc_id, attempt, {ANSWER_FIELDS}, failed_rules FROM judged")
def x5_validate_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_answers(answers(spark, sf_dir)).select("doc_id", "attempt", *FIELDS, "summary", reasons())


@query(
    "x6_retry_fallback",
    f"""WITH {ANSWERS}, best AS (SELECT * FROM judged WHERE failed_rules = '' AND attempt <= 2
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY attempt) = 1)
    SELECT d.doc_id, coalesce(damage_type, 'other') AS damage_type, coalesce(urgency, 'medium') AS urgency,
      coalesce(injury_mentioned, false) AS injury_mentioned, coalesce(third_party_involved, false) AS third_party_involved,
      coalesce(summary, '{UNREADABLE_SUMMARY}') AS summary, 'recorded' AS extractor, b.doc_id IS NULL AS needs_manual_review
    FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id""",
)
def x6_retry_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_valid_answers(documents(spark, sf_dir), answers(spark, sf_dir), "recorded", on="doc_id")


# --- one reading per distinct text -------------------------------------------------------------------------------

DISTINCT = f"""texts AS (SELECT DISTINCT trim(text, '{WHITE_SPACE}') AS text FROM documents),
readings AS ({keyword_sql(WORDS, "texts", "sha256(text) AS text_key")})"""


@query("x7_distinct_inference", f"WITH {DISTINCT} SELECT {', '.join((KEY, *EXTRACTION))} FROM readings")
def x7_distinct_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings, _ = extract_distinct(documents(spark, sf_dir), "text", keyword_extractor(WORDS))
    return readings


@query(
    "x7_cached_inference",
    f"""WITH {DISTINCT}, seen AS (SELECT DISTINCT sha256(trim(text, '{WHITE_SPACE}')) AS text_key FROM documents
      WHERE lang = 'en')
    SELECT d.doc_id, r.damage_type, r.urgency, r.text_key IN (SELECT text_key FROM seen) AS from_cache
    FROM documents d JOIN readings r ON sha256(trim(d.text, '{WHITE_SPACE}')) = r.text_key""",
)
def x7_cached_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The English texts were read earlier; only the others are read now; every document gets its reading."""
    docs = documents(spark, sf_dir)
    _, cache = extract_distinct(docs.filter("lang = 'en'"), "text", keyword_extractor(WORDS))
    readings, fresh = extract_distinct(docs, "text", keyword_extractor(WORDS), cache)
    marked = readings.join(fresh.select(KEY, F.lit(True).alias("_fresh")), KEY, "left")
    return attach(docs, "text", marked).select("doc_id", "damage_type", "urgency", F.col("_fresh").isNull().alias("from_cache"))


def read_by_length(texts: pd.DataFrame) -> pd.DataFrame:
    """A stand-in for a user's reader: one Arrow batch of distinct texts in, a JSON answer per text out.

    The first digit of a text's key decides how it fails: 0 to 2 give a damage type outside the list until the reader is
    told so; 3 never gives JSON; 4 gives no answer at all.
    """
    rows = []
    for key, text, error in zip(texts[KEY], texts["text"], texts["last_error"], strict=True):
        told = isinstance(error, str) and "damage_type_known" in error
        size = len(text)
        fields = {
            "damage_type": "flooding" if key[0] in "012" and not told else "other",
            "urgency": "high" if size > 1000 else "low",
            "injury_mentioned": size % 2 == 1,
            "third_party_involved": False,
            "summary": f"{size} characters",
        }
        if key[0] != "4":
            rows.append((key, "no json" if key[0] == "3" else json.dumps(fields)))
    return pd.DataFrame(rows, columns=[KEY, "answer"])


@query(
    "x8_batch_extractor",
    f"""WITH t AS (SELECT doc_id, length(trim(text, '{WHITE_SPACE}')) AS size,
                      substr(sha256(trim(text, '{WHITE_SPACE}')), 1, 1) IN ('3', '4') AS unread FROM documents)
    SELECT doc_id, 'other' AS damage_type, CASE WHEN unread THEN 'medium' WHEN size > 1000 THEN 'high' ELSE 'low' END AS urgency,
      NOT unread AND size % 2 = 1 AS injury_mentioned, false AS third_party_involved,
      CASE WHEN unread THEN '{UNREADABLE_SUMMARY}' ELSE size || ' characters' END AS summary,
      'by length' AS extractor, unread AS needs_manual_review FROM t""",
)
def x8_batch_extractor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers are checked, bad ones asked for once more with the reason, and the rest left to people."""
    docs = documents(spark, sf_dir)
    readings, _ = extract_distinct(docs, "text", batch_extractor("by length", read_by_length))
    return attach(docs, "text", readings).select("doc_id", *EXTRACTION)


# --- evaluation --------------------------------------------------------------------------------------------------


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword fields next to labels that disagree here and there."""
    got = found(spark, sf_dir)
    expected = got.withColumns(
        {
            "damage_type": F.when(chosen("type", 0.2, "doc_id"), F.lit("other")).otherwise(F.col("damage_type")),
            "urgency": F.when(chosen("urgency", 0.3, "doc_id"), F.lit("low")).otherwise(F.col("urgency")),
            "injury_mentioned": F.col("injury_mentioned") | chosen("hurt", 0.1, "doc_id"),
        }
    )
    return compare_with_labels(got.filter(~chosen("unread", 0.05, "doc_id")), expected, "doc_id", ["lang"])


COMPARED = f"""{READ}, compared AS (SELECT doc_id, lang, {hit_sql("unread", 0.05, "doc_id")} AS unread,
  damage_type AS got_damage_type, urgency AS got_urgency, injury_mentioned AS got_injury_mentioned,
  third_party_involved AS got_third_party_involved,
  CASE WHEN {hit_sql("type", 0.2, "doc_id")} THEN 'other' ELSE damage_type END AS expected_damage_type,
  CASE WHEN {hit_sql("urgency", 0.3, "doc_id")} THEN 'low' ELSE urgency END AS expected_urgency,
  injury_mentioned OR {hit_sql("hurt", 0.1, "doc_id")} AS expected_injury_mentioned,
  third_party_involved AS expected_third_party_involved FROM found)"""
ALL_RIGHT = "NOT unread AND " + " AND ".join(f"got_{f} = expected_{f}" for f in FIELDS)
ACCURACIES = ", ".join(
    f"round(avg(CAST(NOT unread AND got_{f} = expected_{f} AS INTEGER)), 4) AS accuracy_{f}" for f in FIELDS
)


@query(
    "x10_extraction_eval",
    f"""WITH {COMPARED} SELECT coalesce(lang, 'all') AS lang, count(*) AS cases, {ACCURACIES},
      round(avg(CAST({ALL_RIGHT} AS INTEGER)), 4) AS accuracy_all_fields,
      round(avg(CAST(unread AS INTEGER)), 4) AS manual_review_rate
    FROM compared GROUP BY ROLLUP (lang)""",
)
def x10_extraction_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language and over all; a document without a reading is wrong."""
    judged = lineage_cut(compared(spark, sf_dir))
    total = extraction_accuracy(judged).withColumn("lang", F.lit("all"))
    return extraction_accuracy(judged, "lang").unionByName(total)


@query(
    "x11_extraction_errors",
    f"WITH {COMPARED} SELECT doc_id, concat_ws('; ', "
    + ", ".join(
        f"CASE WHEN unread OR got_{f} <> expected_{f} THEN '{f}: expected ' || expected_{f} || ', got ' || "
        f"CASE WHEN unread THEN 'nothing' ELSE CAST(got_{f} AS VARCHAR) END END"
        for f in FIELDS
    )
    + f") AS errors FROM compared WHERE NOT ({ALL_RIGHT})",
)
def x11_extraction_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction_errors(compared(spark, sf_dir), "doc_id")


@query(
    "s11_extraction_log",
    f"""WITH {READ} SELECT CAST(json_object('claim_id', doc_id, 'extractor', extractor, 'damage_type', damage_type,
      'urgency', urgency, 'needs_manual_review', needs_manual_review, 'extraction_ms', 0.5) AS VARCHAR) AS record FROM found""",
)
def s11_extraction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction_log(found(spark, sf_dir).withColumnRenamed("doc_id", "claim_id"), 0.5)


@query(
    "x9_triage",
    f"""WITH {ACCEPTED}, described AS (SELECT DISTINCT claim_id, description AS text FROM accepted),
    readings AS ({keyword_sql(WORDS, "described", "claim_id")})
    SELECT readings.*, true AS scored, '{KEYWORD_NOTE}' AS note FROM readings JOIN accepted USING (claim_id)""",
)
def x9_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and extraction of every acceptable claim, with the descriptions read where they are."""
    feeds = stored_feeds(spark, sf_dir)
    wanted = lineage_cut(requests(spark, sf_dir, feeds))  # scored and read
    scored, _ = score_batch(wanted, scorer(spark, sf_dir, feeds))
    described = wanted.select("claim_id", "description").distinct()
    both = triage(scored, extract_rows(described, "description", keyword_extractor(WORDS)))
    return both.select("claim_id", *EXTRACTION, F.col("fraud_score").isNotNull().alias("scored"), "note")


