"""Quality classifier: logistic regression over hashed word n-grams, fitted by follow-the-regularised-leader updates.

Features are five families of n-grams: words, word pairs, and single word shapes, pairs and triples of them. A shape tells
what a word is made of (``The`` is ``Xx``, ``was,`` is ``x,``) and whether the word before it was the same. Every n-gram is
hashed to one of 2^18 weights; a feature's value is its share of its family in the text. A text's score is the logistic
value of the bias and the sparse dot product of weights and values, so texts of any length are alike.

Fitting uses at most ``max_rows`` labelled rows, those with the least hash. They are dealt to a few shards; each shard's
task runs the per-coordinate updates over its rows, and the shards' states are averaged, for a few rounds. The driver sees
the model only (2^18 + 1 weights), never rows.

Defined results: rows whose ``crc32(id as text) mod 4`` is 2 are held out of fitting; a null id is not held out, and has no
label. A null text is empty; an empty text is scored by the bias. Null labels, and ids with conflicting labels, are not
learned from. With no row to learn from every score is 0.5 and ``good_documents`` keeps all rows. Repeated rows are learned
from once and scored alike. An empty table gives an empty table. Labels, ids and other columns are no input of a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.frames import byte_texts, in_slices, record, row_key
from trustlake.llm.words import CACHE_BYTES, CACHE_ENTRIES, WordHashes, mixed
from trustlake.session import lineage_cut

WEIGHT_BITS = 18
BIAS = 1 << WEIGHT_BITS
MAX_ROWS = 8_192
SHARDS, ROUNDS, EPOCHS = 4, 2, 3
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.01, 0.001
ACCEPT = 0.7

_SHAPES = bytes(
    ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else ord("9") if 48 <= b <= 57 else b
    for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)
_SAME = np.uint64(xxhash.xxh64_intdigest(b"the word before is the same"))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class ShapeHashes(dict):
    """Hashes of word shapes, by word, remembered."""

    def __missing__(self, word: bytes) -> int:
        shape = _RUN.sub(rb"\1", word.translate(_SHAPES))
        value = xxhash.xxh64_intdigest(b"shape " + shape)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = value
        return value


class Features:
    """The weights' numbers of a text's n-grams, one array per family."""

    def __init__(self) -> None:
        self.words, self.shapes = WordHashes(), ShapeHashes()

    def of(self, text: bytes) -> list[np.ndarray]:
        cased = text.split()
        if not cased:
            return []
        words = self.words.of(text.lower().split())
        shapes = np.fromiter(map(self.shapes.__getitem__, cased), np.uint64, len(cased))
        shapes[1:][words[1:] == words[:-1]] ^= _SAME
        shape_pairs = shapes[:-1] * _FACTOR + shapes[1:]
        families = (
            words,
            words[:-1] * _FACTOR + words[1:],
            shapes,
            shape_pairs,
            shape_pairs[:-1] * _FACTOR + shapes[2:],
        )
        shift = np.uint64(64 - WEIGHT_BITS)
        return [
            (mixed(f * _FACTOR + np.uint64(n)) >> shift).astype(np.int64) for n, f in enumerate(families) if len(f)
        ]


def sparse(families: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct weights of a text, the bias among them, and their values."""
    places, values = [np.array([BIAS])], [np.ones(1)]
    for family in families:
        place, count = np.unique(family, return_counts=True)
        places.append(place)
        values.append(count / len(family))
    place, at = np.unique(np.concatenate(places), return_inverse=True)
    return place, np.bincount(at, np.concatenate(values))


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that a state of sums stands for."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def logistic(value: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(value, -500, 500))))


def learn(z: np.ndarray, n: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """One pass of updates over the rows, in place."""
    for place, value, label in rows:
        weight = weights_of(z[place], n[place])
        slope = (logistic(weight @ value) - label) * value
        rate = (np.sqrt(n[place] + slope * slope) - np.sqrt(n[place])) / ALPHA
        z[place] += slope - rate * weight
        n[place] += slope * slope


def held_out(ident: Column) -> Column:
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, max_rows: int, shards: int
) -> DataFrame:
    """``shard, place, text, label`` of at most ``max_rows`` labelled rows, stored."""
    ident = F.col(id_column).cast("bigint")
    known = (
        labels.select(ident.alias("id"), F.col(label_column).cast("int").alias("label"))
        .filter("id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .select("id", "label")
    )
    rows = docs.select(
        ident.alias("id"),
        row_key(F.col(id_column), F.col(text_column)).alias("key"),
        F.col(text_column).cast("string").cast("binary").alias("text"),
    ).filter(~held_out(F.col("id")))
    labelled = rows.select("id", "key").join(known, "id").groupBy("key").agg(F.first("label").alias("label"))
    chosen = lineage_cut(labelled.orderBy(F.xxhash64("key"), "key").limit(max_rows))
    # at most max_rows keys of 32 bytes
    return lineage_cut(
        rows.select("key", "text")
        .join(F.broadcast(chosen), "key")
        .dropDuplicates(["key"])
        .select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), F.xxhash64("key", F.lit(1)).alias("place"), "text", "label")
    )


def _trainer(z: np.ndarray, n: np.ndarray, epochs: int):
    """A function that takes a shard's rows on from the state ``z``, ``n``."""

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        features = Features()
        pdf = pdf.sort_values(["place", "text"])
        shard = [(*sparse(features.of(t or b"")), y) for t, y in zip(pdf["text"], pdf["label"], strict=True)]
        own_z, own_n = z.copy(), n.copy()
        for _ in range(epochs):
            learn(own_z, own_n, shard)
        used = np.flatnonzero(own_n)
        return pd.DataFrame({"place": used, "z": own_z[used], "n": own_n[used]})

    return train


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    max_rows: int = MAX_ROWS,
    shards: int = SHARDS,
    rounds: int = ROUNDS,
    epochs: int = EPOCHS,
) -> np.ndarray | None:
    """The weights, or None where no row has a label."""
    rows = training_rows(docs, labels, id_column, text_column, label_column, max_rows, shards)
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
    for _ in range(rounds):
        states = rows.groupBy("shard").applyInPandas(_trainer(z, n, epochs), "place int, z double, n double")
        mean = states.groupBy("place").agg(F.sum("z").alias("z"), F.sum("n").alias("n"), F.count("*").alias("c")).toArrow()
        if mean.num_rows == 0:
            return None
        place = mean["place"].to_numpy()
        parts = mean["c"].to_numpy()[place == BIAS][0]  # every shard has the bias
        z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
        z[place], n[place] = mean["z"].to_numpy() / parts, mean["n"].to_numpy() / parts
    return weights_of(z, n).astype(np.float32)


def score_text(weights: np.ndarray, families: list[np.ndarray]) -> float:
    """The sparse dot product of a text's values and the weights, as a probability."""
    return logistic(sum(float(weights[f].mean(dtype=np.float64)) for f in families) + float(weights[BIAS]))


def _scored(rows: DataFrame, weights: np.ndarray | None, ident: str) -> DataFrame:
    """``rows`` (an identifying column and ``text``) as that column and ``score``."""
    if weights is None:
        return rows.select(ident, F.lit(0.5).alias("score"))
    kind = rows.schema[ident].dataType
    schema = pa.schema([(ident, pa.binary() if kind.typeName() == "binary" else pa.int64()), ("score", pa.float64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in in_slices(batches):
            scores = [score_text(weights, features.of(text)) for text in byte_texts(batch["text"])]
            yield record(schema, batch[ident], scores)

    return rows.select(ident, "text").mapInArrow(of, f"{ident} {kind.simpleString()}, score double")


def classify_quality(
    docs: DataFrame, weights: np.ndarray | None, id_column: str = "doc_id", text_column: str = "text", accept: float = ACCEPT
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row."""
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text")
    )
    scored = _scored(rows, weights, "doc_id")
    predicted = (F.col("score") >= accept).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def good_documents(
    docs: DataFrame, weights: np.ndarray | None, id_column: str = "doc_id", text_column: str = "text", accept: float = ACCEPT
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier accepts."""
    if weights is None:
        return docs
    # a row's own score decides: only texts go to the workers, and nothing is moved
    @F.arrow_udf("boolean")
    def accepted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features()
        for texts in batches:
            yield pa.array([score_text(weights, features.of(text)) >= accept for text in byte_texts(texts)], pa.bool_())

    return docs.filter(accepted(F.col(text_column).cast("string").cast("binary")))
