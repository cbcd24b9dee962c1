"""Quality rules with an n-gram language model: documents whose perplexity is unusual for their language go.

The models are interpolated modified Kneser-Ney models of four-grams of symbols, counted by Spark over the whole texts of all
documents: two per language, as every document belongs to one of two halves by the hash of its text. A document is scored by the
model of the other half, so that neither it nor its copies can vouch for themselves. A symbol is a small letter, a shift before a capital, a digit, a point, a comma, other ASCII
punctuation, a blank for a run of white space, or one of 32 classes of other characters (by code point, so that the two cases of most
alphabets share a class). 64 symbols bound the model: a four-gram is a number below 2^24, which serves as its hash without
collisions, and a model has at most 17 million n-grams of all sizes, 137 MB as sorted hash arrays. Tasks get as many models as fit
``MODEL_BYTES`` at a time; documents of other models are scored in another pass over the table.

A language's band reaches from its lower to its upper quartile of log perplexity, and ``REACH`` spreads beyond both; the
quartiles are exact and taken over all documents that pass the plain rules. Documents outside fail: text below the band says
the same over and over, text above it is not prose.

Defined results: a null text is an empty one; a null language is a language of its own, the same as an empty name. Texts
without a word fail the plain rules and have no perplexity. Where the other half of a language is empty, all symbols count as
equally likely. A document's verdict depends on its text and language only, so
repeated rows share it; null ids are kept as such. An empty table gives an empty result. A language whose documents are all alike
has quartiles without a distance; its band is then ``LEAST_SPREAD`` wide on both sides, times ``REACH``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.frames import byte_texts, in_slices, record
from trustlake.operators.selection import group_quantile
from trustlake.session import lineage_cut

SYMBOL_BITS = 6
ORDER = 4
BLANK, SHIFT, DIGIT, POINT, COMMA, MARK, OTHER = 0, 27, 28, 29, 30, 31, 32
LEAST_WORDS, MOST_REPEATED = 50, 50
REACH, LEAST_SPREAD = 8.0, 0.05
MODEL_BYTES = 256 << 20
#: n-grams a task holds before it hands on what it has counted.
HELD = 1 << 21
#: Characters, or bytes of words, that are looked at at a time.
SLICE = 1 << 20


def _ascii_symbols() -> np.ndarray:
    table = np.full(128, MARK, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = BLANK
    for place in range(26):
        table[[ord("a") + place, ord("A") + place]] = 1 + place
    table[ord("0") : ord("9") + 1] = DIGIT
    table[ord(".")], table[ord(",")] = POINT, COMMA
    return table


_ASCII = _ascii_symbols()


def symbols(characters: str) -> np.ndarray:
    """The symbols of a stretch of text; runs of blanks stay."""
    codes = np.frombuffer(characters.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.where(codes < 128, _ASCII[np.minimum(codes, 127)], OTHER + codes % 32).astype(np.uint8)
    capitals = np.flatnonzero((codes >= ord("A")) & (codes <= ord("Z")))
    return np.insert(found, capitals, SHIFT) if len(capitals) else found


def four_grams(text: bytes) -> Iterator[np.ndarray]:
    """The numbers of all four-grams of a text, which begins with three blanks and ends with one, slice by slice."""
    characters = text.decode("utf-8", "replace")
    last = np.zeros(ORDER - 1, np.uint8)
    for start in range(0, len(characters), SLICE):
        found = symbols(characters[start : start + SLICE])
        if start + SLICE >= len(characters):
            found = np.append(found, np.uint8(BLANK))
        before = np.concatenate([last[-1:], found[:-1]])
        found = found[(found != BLANK) | (before != BLANK)]
        run = np.concatenate([last, found]).astype(np.int32)
        last = run[-(ORDER - 1) :].astype(np.uint8)
        if len(run) >= ORDER:
            grams = run[: len(run) - ORDER + 1]
            for place in range(1, ORDER):
                grams = (grams << SYMBOL_BITS) | run[place : len(run) - ORDER + 1 + place]
            yield grams


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four-grams of a task's documents by language, added up before they leave the task."""
    schema = pa.schema([("model", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])
    counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str, grams: list[np.ndarray]) -> None:
        new, n = np.unique(np.concatenate(grams), return_counts=True)
        if lang in counts:
            old, had = counts[lang]
            both, place = np.unique(np.concatenate([old, new]), return_inverse=True)
            new, n = both, np.bincount(place, np.concatenate([had, n])).astype(np.int64)
        counts[lang] = new, n

    def handed() -> Iterator[pa.RecordBatch]:
        for lang, (grams, n) in counts.items():
            for start in range(0, len(grams), 100_000):
                part = slice(start, start + 100_000)
                yield record(schema, [lang] * len(grams[part]), grams[part], n[part])
        counts.clear()

    for batch in in_slices(batches, 1 << 22):
        pending: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch["model"].to_pylist(), byte_texts(batch["text"]), strict=True):
            for grams in four_grams(text):
                pending.setdefault(lang, []).append(grams)
                if sum(map(len, pending[lang])) > HELD and len(pending[lang]) > 1:
                    add(lang, pending.pop(lang))
        for lang, grams in pending.items():
            add(lang, grams)
        if sum(len(g) for g, _ in counts.values()) > HELD:
            yield from handed()
    yield from handed()


def count_grams(rows: DataFrame) -> DataFrame:
    """``model, gram, n`` over all ``rows`` (model, text)."""
    parts = rows.select("model", "text").mapInArrow(_counter, "model string, gram int, n bigint")
    return lineage_cut(parts.groupBy("model", "gram").agg(F.sum("n").alias("n")))


def _discounts(orders: DataFrame) -> DataFrame:
    """``model, size, d1, d2, d3``: what is taken off counts of one, two, and more; of each order, from its counts of counts."""
    of = {f"n{i}": F.sum(F.when(F.col("n") == i, 1).otherwise(0)) for i in range(1, 5)}
    met = orders.groupBy("model", "size").agg(*(column.alias(name) for name, column in of.items()))
    shared = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def taken(i: int):
        usual = i - (i + 1) * shared * F.col(f"n{i + 1}") / F.col(f"n{i}")
        # too few counts to tell: half
        known = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col(f"n{i}") > 0)
        return F.when(known, F.greatest(usual, F.lit(0.0))).otherwise(F.lit(i / 2))

    return met.select("model", "size", *(taken(i).alias(f"d{i}") for i in (1, 2, 3)))


def kneser_ney(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``model, key, value`` of all n-grams (log probability) and of all contexts (log weight of the shorter n-gram).

    The longest n-grams count how often they occur, shorter ones how many different symbols stand before them. A key is
    the n-gram's number with a one above it, so that n-grams of all sizes share one sorted array.
    """
    sizes = {ORDER: grams.select("model", "gram", "n")}
    for size in range(ORDER - 1, 0, -1):
        rest = F.col("gram").bitwiseAND((1 << (SYMBOL_BITS * size)) - 1).alias("gram")
        sizes[size] = sizes[size + 1].select("model", rest).groupBy("model", "gram").agg(F.count("*").alias("n"))
    orders = None
    for size, counted in sizes.items():
        named = counted.select("model", F.lit(size).alias("size"), "gram", "n")
        orders = named if orders is None else orders.unionByName(named)
    orders = lineage_cut(orders.withColumn("context", F.shiftright("gram", SYMBOL_BITS)))
    off = lineage_cut(_discounts(orders))
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    taken = orders.join(off, ["model", "size"]).withColumn("off", F.least(discount, F.col("n").cast("double")))
    contexts = lineage_cut(
        taken.groupBy("model", "size", "context").agg(
            F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("weight")
        )
    )
    known = lineage_cut(
        taken.join(contexts, ["model", "size", "context"]).select(
            "model", "size", "gram", ((F.col("n") - F.col("off")) / F.col("total")).alias("own"), "weight"
        )
    )
    shorter = None
    for size in range(1, ORDER + 1):
        here = known.filter(F.col("size") == size).withColumn("rest", F.col("gram").bitwiseAND((1 << (SYMBOL_BITS * (size - 1))) - 1))
        if shorter is None:
            lower = here.withColumn("below", F.lit(1.0 / (1 << SYMBOL_BITS)))
        else:
            lower = here.join(shorter.select("model", F.col("gram").alias("rest"), F.col("p").alias("below")), ["model", "rest"])
        shorter = lineage_cut(
            lower.select("model", "gram", (F.col("own") + F.col("weight") * F.col("below")).alias("p"), F.lit(size).alias("size"))
        )
        every = shorter if size == 1 else every.unionByName(shorter)

    def keyed(number: str, size: Column) -> Column:
        return (F.col(number) + F.pow(F.lit(float(1 << SYMBOL_BITS)), size).cast("int")).alias("key")

    probabilities = every.select("model", keyed("gram", F.col("size")), F.log("p").alias("value"))
    log_weight = F.log(F.greatest("weight", F.lit(1e-12)))
    backoffs = contexts.select("model", keyed("context", F.col("size") - 1), log_weight.alias("value"))
    return lineage_cut(probabilities), lineage_cut(backoffs)


class SortedHashes:
    """Values by number, in two sorted arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        place = np.argsort(keys)
        self.keys, self.values = keys[place].astype(np.int32), values[place].astype(np.float32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, and which keys there are."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[place].astype(np.float64), self.keys[place] == keys


class LanguageModel:
    """Log probabilities of the last symbols of four-grams."""

    def __init__(self, probabilities: SortedHashes, backoffs: SortedHashes) -> None:
        self.probabilities, self.backoffs = probabilities, backoffs

    def logs(self, grams: np.ndarray) -> np.ndarray:
        """By the longest known n-gram; where it is unknown, by the context's weight and the n-gram without its first symbol."""
        total = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        for size in range(ORDER, 0, -1):
            rest = grams[open_] & ((1 << (SYMBOL_BITS * size)) - 1)
            value, known = self.probabilities.find(rest | (1 << (SYMBOL_BITS * size)))
            total[open_[known]] += value[known]
            open_, rest = open_[~known], rest[~known]
            if not len(open_):
                return total
            weight, has = self.backoffs.find((rest >> SYMBOL_BITS) | (1 << (SYMBOL_BITS * (size - 1))))
            total[open_] += np.where(has, weight, 0.0)
        total[open_] -= math.log(1 << SYMBOL_BITS)
        return total


_NOTHING = SortedHashes(np.empty(0), np.empty(0))
UNTRAINED = LanguageModel(_NOTHING, _NOTHING)


def log_perplexity(model: LanguageModel, text: bytes) -> float | None:
    """The mean negative log probability of a text's symbols."""
    total, count = 0.0, 0
    for grams in four_grams(text):
        total -= float(model.logs(grams).sum())
        count += len(grams)
    return total / count if count else None


class _Numbers(dict):
    """Words numbered by their first occurrence."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_numbers(text: bytes) -> np.ndarray:
    """The words of a text, each as its number, without holding all of them at once."""
    numbers, parts, start = _Numbers(), [], 0
    while start < len(text):
        end = len(text)
        if end - start > SLICE:
            found = _SPACE.search(text, start + SLICE)
            end = found.end() if found else end
        words = text[start:end].split()
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        start = end
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def repeated_words(words: np.ndarray) -> int:
    """Words in three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    span = int(words.max()) + 1
    if span >= len(words) - 2:
        return 0  # so many different words that no three can stand twice
    _, pair = np.unique(words[:-2] * span + words[1:-1], return_inverse=True)
    _, window, met = np.unique(pair * span + words[2:], return_inverse=True, return_counts=True)
    often = met[window] > 1
    covered = np.zeros(len(words), bool)
    for place in range(3):
        covered[place : place + len(often)] |= often
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    seen, repeats, start = set(), 0, 0
    while start <= len(text):
        end = text.find(b"\n", start)
        end = len(text) if end < 0 else end
        line = text[start:end]
        if line.strip():
            repeats += line in seen
            seen.add(line)
        start = end + 1
    return repeats


def plain_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    words = _word_numbers(text)
    within = text.translate(None, b" \t\n\v\f\r")
    continuing = len(within) - len(within.translate(None, bytes(range(0x80, 0xC0))))
    marked = len(text) - len(text.translate(None, b"#*$%&|<>"))
    return len(words), len(within) - continuing, marked, repeated_lines(text), repeated_words(words)


def _scorer(models: dict[str, LanguageModel]):
    """Rows (doc_id, lang, model, text) as their counts and log perplexities."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("lang", pa.string()), *((c, pa.int64()) for c in counts), ("log_perplexity", pa.float64())]
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows = [
                (*plain_counts(text), log_perplexity(models.get(name, UNTRAINED), text) if text.strip() else None)
                for name, text in zip(batch["model"].to_pylist(), byte_texts(batch["text"]), strict=True)
            ]
            yield record(schema, batch["doc_id"], batch["lang"], *map(list, zip(*rows, strict=True)))

    return of


MEASURED = (
    "doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, log_perplexity double"
)


def _models(probabilities: DataFrame, backoffs: DataFrame) -> dict[str, LanguageModel]:
    def arrays(values: DataFrame) -> dict[str, SortedHashes]:
        found = values.select("model", "key", F.col("value").cast("float").alias("value")).toArrow().to_pandas()
        return {name: SortedHashes(part["key"].to_numpy(), part["value"].to_numpy()) for name, part in found.groupby("model")}

    known, weights = arrays(probabilities), arrays(backoffs)
    return {name: LanguageModel(known[name], weights[name]) for name in known}


def half(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(2))


def measure(rows: DataFrame, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """The counts and the log perplexity of each of ``rows`` (doc_id, lang, text)."""
    own, other = (F.concat(number.cast("string"), F.lit("|"), "lang") for number in (half(F.col("text")), 1 - half(F.col("text"))))
    probabilities, backoffs = kneser_ney(count_grams(rows.select(own.alias("model"), "text")))
    entries = probabilities.count() + backoffs.count()
    passes = max(1, math.ceil(8 * entries / model_bytes))
    turn = F.pmod(F.xxhash64("model"), F.lit(passes))
    asked = rows.select("doc_id", "lang", other.alias("model"), "text")
    measured = None
    for number in range(passes):
        models = _models(probabilities.filter(turn == number), backoffs.filter(turn == number))
        part = asked.filter(turn == number).mapInArrow(_scorer(models), MEASURED)
        measured = part if measured is None else measured.unionByName(part)
    return lineage_cut(measured)


def bands(measured: DataFrame, reach: float = REACH, least_spread: float = LEAST_SPREAD) -> DataFrame:
    """``lang, lower, upper``: between what log perplexities a document counts as prose of its language."""
    quartiles = [group_quantile(measured, ["lang"], "log_perplexity", q, f"q{round(4 * q)}") for q in (0.25, 0.75)]
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least_spread))
    return quartiles[0].join(quartiles[1], "lang").select(
        "lang", (F.col("q1") - reach * spread).alias("lower"), (F.col("q3") + reach * spread).alias("upper")
    )


def judge_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    reach: float = REACH,
    model_bytes: int = MODEL_BYTES,
) -> DataFrame:
    """Counts, perplexity and verdict of every document."""
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(lang_column).cast("string"), F.lit("")).alias("lang"),
        F.col(text_column).cast("string").cast("binary").alias("text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    measured = measure(rows, model_bytes).withColumn("base_failed", failed)
    limits = lineage_cut(bands(measured.filter("NOT base_failed"), reach))
    inside = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    return measured.join(limits, "lang", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        F.exp("log_perplexity").alias("perplexity"),
        F.exp("lower").alias("lower"),
        F.exp("upper").alias("upper"),
    )
