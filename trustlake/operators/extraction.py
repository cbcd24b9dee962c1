"""Structured fields from free text: keyword rules, answer validation, one reading per distinct text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.functions.keywords import (
    CLAIM_WORDS,
    DAMAGE_TYPES,
    SUMMARY_CHARS,
    URGENCIES,
    KeywordTable,
    first_label,
    first_sentence,
    mentions,
    stripped,
)
from trustlake.operators.rules import FAILED, Rule, apply_rules, member_of
from trustlake.session import lineage_cut

FIELDS = ("damage_type", "urgency", "injury_mentioned", "third_party_involved")
FLAGS = ("injury_mentioned", "third_party_involved")
EXTRACTION = (*FIELDS, "summary", "extractor", "needs_manual_review")
KEY = "text_key"
MAX_ATTEMPTS = 2
#: Of a reader's error, what the next reading is told.
ERROR_CHARS = 500

# What is reported when no answer could be read, and when keyword rules were used.
KEYWORD_EXTRACTOR = "fake"
UNREADABLE_SUMMARY = "Could not be read automatically."
KEYWORD_NOTE = "No LLM configured: these fields come from simple keyword rules."

# An extractor reads a frame (text_key, text) and returns (text_key, *EXTRACTION).
Extractor = Callable[[DataFrame], DataFrame]


def text_key(text: str | Column) -> Column:
    """Content hash: texts that differ only in outer white space are the same text."""
    return F.sha2(stripped(F.col(text) if isinstance(text, str) else text), 256)


# --- keyword rules -----------------------------------------------------------------------------------------------


def with_keyword_fields(df: DataFrame, text: str = "text", words: KeywordTable = CLAIM_WORDS) -> DataFrame:
    """Add the extraction columns, all of them built-in expressions over the whole text."""
    lowered = df.withColumn("_lower", F.lower(F.col(text)))
    found = F.col("_lower")
    return lowered.select(
        *df.columns,
        first_label(found, words.labels, words.default).alias("damage_type"),
        words.level(found).alias("urgency"),
        mentions(found, words.injury).alias("injury_mentioned"),
        mentions(found, words.third_party).alias("third_party_involved"),
        first_sentence(F.col(text)).alias("summary"),
        F.lit(KEYWORD_EXTRACTOR).alias("extractor"),
        F.lit(False).alias("needs_manual_review"),
    )


def keyword_extractor(words: KeywordTable = CLAIM_WORDS) -> Extractor:
    def extract(texts: DataFrame) -> DataFrame:
        return with_keyword_fields(texts, "text", words).select(KEY, *EXTRACTION)

    # a pure expression: rows can be read where they are
    def inline(df: DataFrame, text: str) -> DataFrame:
        read = with_keyword_fields(df.withColumn("_read", stripped(F.col(text))), "_read", words)
        known = F.col(text).isNotNull()
        return read.select(*df.columns, *(F.when(known, F.col(c)).alias(c) for c in EXTRACTION))

    extract.inline = inline
    return extract


def batch_extractor(name: str, read_batch: Callable, attempts: int = MAX_ATTEMPTS) -> Extractor:
    """An extractor around a user's reader.

    ``read_batch`` takes a pandas frame (text_key, text, last_error) and returns one of (text_key, answer), the answers
    being JSON texts. Every answer is checked by the answer rules. Texts without a valid answer are read again, with the
    names of the broken rules, or the reader's own error, as ``last_error`` (NULL at first); after ``attempts`` readings
    the fallback stands and the text is left to people. A reader that raises fails its batch only. Each round's answers
    are stored, so no text is read more often than that.
    """

    def read(frames: Iterator) -> Iterator:
        for frame in frames:
            try:
                given = read_batch(frame)[[KEY, "answer"]].assign(reader_error=None)
                # an answer to a question that was not asked is none
                yield frame[[KEY]].merge(given.drop_duplicates(KEY), on=KEY, how="left")
            except Exception as error:  # noqa: BLE001 - whatever a user's reader raises is a failed reading
                yield frame[[KEY]].assign(answer=None, reader_error=f"{type(error).__name__}: {error}"[:ERROR_CHARS])

    def extract(texts: DataFrame) -> DataFrame:
        waiting = texts.select(KEY, "text", F.lit(None).cast("string").alias("last_error"))
        answers = None
        for attempt in range(1, attempts + 1):
            raw = waiting.mapInPandas(read, f"{KEY} string, answer string, reader_error string")
            read_once = lineage_cut(read_answers(raw).withColumn("attempt", F.lit(attempt)))
            answers = read_once if answers is None else answers.unionByName(read_once)
            if attempt < attempts:
                error = F.coalesce("reader_error", F.array_join(FAILED, ", "))
                failed = read_once.filter(F.size(FAILED) > 0).select(KEY, error.alias("last_error"))
                waiting = texts.select(KEY, "text").join(failed, KEY)
        return _first_valid(texts, answers, f"{name}", KEY)

    return extract


def unreadable(name: str) -> Extractor:
    """An extractor that leaves every text to people."""

    def extract(texts: DataFrame) -> DataFrame:
        nothing = texts.select(KEY, F.lit(None).cast("string").alias("answer"), F.lit(1).alias("attempt")).limit(0)
        return _first_valid(texts, read_answers(nothing), name, KEY)

    return extract


def choose_extractor(settings: Mapping[str, str], read_batch: Callable | None = None) -> Extractor:
    """The user's own reader if the settings name a model and one is given, otherwise the keyword rules."""
    model = settings.get("model", "").strip()
    return batch_extractor(f"llm:{model}", read_batch) if model and read_batch is not None else keyword_extractor()


# --- answers of a model ------------------------------------------------------------------------------------------

ANSWER_RULES = (
    Rule("answer_is_object", "_parsed IS NOT NULL"),
    Rule("damage_type_known", member_of("damage_type", DAMAGE_TYPES)),
    Rule("urgency_known", member_of("urgency", URGENCIES)),
    Rule("injury_present", "injury_mentioned IS NOT NULL"),
    Rule("third_party_present", "third_party_involved IS NOT NULL"),
    Rule("summary_fits", f"length(summary) <= {SUMMARY_CHARS}"),
)

# Texts that count as a truth value besides JSON's own true and false (and the numbers 1 and 0).
TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")


def read_answers(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """Parse JSON answers and check them against the answer rules; adds the fields and ``_failed_rules``."""

    def member(name: str, kind: str) -> Column:
        return F.try_variant_get("_parsed", f"$.{name}", kind)

    def json_kind(name: str) -> Column:
        return F.schema_of_variant(member(name, "variant"))

    def text(name: str) -> Column:
        return F.when(json_kind(name) == "STRING", member(name, "string")).alias(name)

    def flag(name: str) -> Column:
        value = F.lower(member(name, "string"))
        scalar = ~json_kind(name).startswith("OBJECT") & ~json_kind(name).startswith("ARRAY")
        truth = F.when(value.isin(*TRUE_TEXTS), F.lit(True)).when(value.isin(*FALSE_TEXTS), F.lit(False))
        return F.when(scalar, truth).alias(name)

    parsed = answers.withColumn("_parsed", F.try_parse_json(F.col(answer)))
    fields = parsed.select(
        *answers.columns,
        "_parsed",
        text("damage_type"),
        text("urgency"),
        *(flag(name) for name in FLAGS),
        text("summary"),
    )
    return apply_rules(fields, ANSWER_RULES).drop("_parsed")


def first_valid_answers(
    keys: DataFrame, answers: DataFrame, extractor: str, on: str = KEY, attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """One extraction per key: its earliest valid answer among the first ``attempts``, else the fallback.

    ``answers`` has (key, attempt, answer). The choice is an aggregate, so any number of answers per key is folded
    before it is shuffled.
    """
    return _first_valid(keys, read_answers(answers.filter(F.col("attempt") <= attempts)), extractor, on)


def _first_valid(keys: DataFrame, read: DataFrame, extractor: str, on: str) -> DataFrame:
    """The choice among answers that have been read and checked."""
    fields = [*FIELDS, "summary"]
    # a condition inside the aggregate, not a filter: a filter would be pushed below the parsing and repeat it per rule
    valid = F.when(F.size(FAILED) == 0, F.struct("attempt", *fields))
    best = read.groupBy(on).agg(F.min(valid).alias("_best"))
    joined = keys.select(on).join(best, on, "left")
    missing = F.col("_best").isNull()
    fallback = {
        "damage_type": F.lit("other"),
        "urgency": F.lit("medium"),
        "injury_mentioned": F.lit(False),
        "third_party_involved": F.lit(False),
        "summary": F.lit(UNREADABLE_SUMMARY),
    }
    return joined.select(
        on,
        *(F.coalesce(F.col(f"_best.{f}"), fallback[f]).alias(f) for f in fields),
        F.lit(extractor).alias("extractor"),
        missing.alias("needs_manual_review"),
    )


# --- one reading per distinct text -------------------------------------------------------------------------------


def distinct_texts(df: DataFrame, text: str) -> DataFrame:
    """(text_key, text): every distinct text once, without outer white space; copies are folded before the shuffle."""
    return df.select(stripped(F.col(text)).alias("text")).distinct().select(text_key("text").alias(KEY), "text")


def extract_distinct(
    df: DataFrame, text: str, extractor: Extractor, cache: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Read each distinct text once, skipping those in ``cache``.

    Returns (extraction per text_key, rows to append to the cache). What was read is stored at once, so that no use of
    the two results runs the extractor again. Fallbacks are not worth remembering: a text that could not be read is
    tried again next time.
    """
    texts = distinct_texts(df, text)
    if cache is not None:
        texts = texts.join(cache.select(KEY), KEY, "left_anti")
    fresh = lineage_cut(extractor(texts).select(KEY, *EXTRACTION))
    remember = fresh.filter(~F.col("needs_manual_review"))
    if cache is None:
        return fresh, remember
    wanted = df.select(text_key(text).alias(KEY))
    known = cache.join(wanted, KEY, "left_semi").select(KEY, *EXTRACTION)
    return known.unionByName(fresh), remember


def attach(df: DataFrame, text: str, extractions: DataFrame) -> DataFrame:
    """Give every row the extraction of its text. AQE splits a text that very many rows share."""
    return df.withColumn(KEY, text_key(text)).join(extractions, KEY, "left").drop(KEY)


def extract_rows(df: DataFrame, text: str, extractor: Extractor) -> DataFrame:
    """Every row with the extraction of its text: by the extractor's expression where it has one, without moving a row; else
    each distinct text is read once."""
    inline = getattr(extractor, "inline", None)
    if inline is not None:
        return inline(df, text)
    return attach(df, text, extract_distinct(df, text, extractor)[0])


def triage(scored: DataFrame, extracted: DataFrame, key: str = "claim_id") -> DataFrame:
    """Score and extraction side by side; a score without an extraction stays. ``extracted`` has one row per key."""
    note = F.when(F.col("extractor") == KEYWORD_EXTRACTOR, F.lit(KEYWORD_NOTE))
    return scored.join(extracted.select(key, *EXTRACTION), key, "left").withColumn("note", note)


# --- evaluation --------------------------------------------------------------------------------------------------


def _right(field: str) -> Column:
    return ~F.col("unanswered") & F.col(f"got_{field}").eqNullSafe(F.col(f"expected_{field}"))


def compare_with_labels(got: DataFrame, expected: DataFrame, on: str, keep: Sequence[str] = ()) -> DataFrame:
    """(key, expected_*, got_*, *keep): predictions next to their labels; a case without a prediction keeps NULLs."""
    left = expected.select(on, *keep, *(F.col(f).alias(f"expected_{f}") for f in FIELDS))
    right = got.select(on, "needs_manual_review", *(F.col(f).alias(f"got_{f}") for f in FIELDS))
    joined = left.join(right.withColumn("_answered", F.lit(True)), on, "left")
    unread = F.col("_answered").isNull()
    # nobody has read such a case, so somebody has to
    return joined.withColumn("needs_manual_review", F.coalesce("needs_manual_review", F.lit(True))).select(
        "*", unread.alias("unanswered")
    ).drop("_answered")


def extraction_accuracy(compared: DataFrame, group: str | None = None, digits: int = 4) -> DataFrame:
    """Share of right fields over all rows, or per group. A case without a prediction counts as wrong in every field."""
    every = F.lit(True)
    for f in FIELDS:
        every = every & _right(f)

    def share(condition: Column, name: str) -> Column:
        return F.round(F.avg(condition.cast("int")), digits).alias(name)

    return compared.groupBy(*([group] if group else [])).agg(
        F.count(F.lit(1)).alias("cases"),
        *(share(_right(f), f"accuracy_{f}") for f in FIELDS),
        share(every, "accuracy_all_fields"),
        share(F.col("needs_manual_review"), "manual_review_rate"),
    )


def extraction_errors(compared: DataFrame, on: str) -> DataFrame:
    """(key, errors): only rows with a wrong field, each as ``field: expected x, got y``."""
    lines = []
    wrong = F.lit(False)
    for f in FIELDS:
        wrong = wrong | ~_right(f)
        line = F.concat(
            F.lit(f"{f}: expected "),
            F.coalesce(F.col(f"expected_{f}").cast("string"), F.lit("nothing")),
            F.lit(", got "),
            F.coalesce(F.col(f"got_{f}").cast("string"), F.lit("nothing")),
        )
        lines.append(F.when(~_right(f), line))
    return compared.filter(wrong).select(on, F.concat_ws("; ", *lines).alias("errors"))
