"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash containment search.

A text's words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters; its shingles are runs of five
words, and an item of fewer words is one shingle of all of them. A document holds an item when at least ``threshold`` of
the item's distinct shingles are in it.

Documents are far longer than items, so signatures of whole documents would hardly ever agree with those of items. The
search therefore hashes all shingles with one function and sketches the items only: items are partitioned by size (powers
of two), and an item's sketch is its ``k`` least hashes, ``k`` being one more than the largest number of shingles that an
item of its partition can miss and still reach the threshold. A document that holds an item thus has one of its sketch's
shingles at least, whatever the document's length: candidates lose nothing. A bit set of bounded size, made from all
sketches, goes to the documents, so that nearly all other shingles, and all documents without a hit, are never moved. Every candidate is then verified by comparing
shingles as texts.

Defined results: null or wordless items match nothing, null or wordless documents hold nothing. Items repeated with equal
id and text count once; repeated documents give repeated rows. A null id is kept as null. Empty tables give no rows.
Other columns are ignored by ``contained_items`` and kept by ``without_leaks``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from trustlake.llm.frames import ROW, byte_texts, field, in_slices, packed_with_text, record, row_key, row_texts, unpacked
from trustlake.llm.words import WordHashes, plain_words, run_hashes
from trustlake.session import lineage_cut

WIDTH = 5
THRESHOLD = 0.8
#: The bit set has 2^14 to 2^15 bits for each hash in it, at least 2^LEAST_BITS (2 MB) and at most 2^MOST_BITS (64 MB).
LEAST_BITS, MOST_BITS, SPARE_BITS = 24, 29, 14
_HITS = StructField("hits", ArrayType(StructType([StructField("width", IntegerType()), StructField("hash", LongType())])))


def bits_for(hashes: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, hashes.bit_length() + SPARE_BITS))


def sketch_size(shingles: int, threshold: Fraction) -> int:
    """Least hashes to keep for an item: more than any item of its size partition may miss."""
    upper = 1 << (shingles - 1).bit_length()
    return min(shingles, floor((1 - threshold) * upper) + 1)


def _keyed(df: DataFrame, id_column: str, text_column: str, ident: str) -> DataFrame:
    return df.select(
        row_key(F.col(id_column), F.col(text_column)).alias(f"{ident}_key"),
        F.col(id_column).cast("bigint").alias(f"{ident}_id"),
        F.col(text_column).cast("string").cast("binary").alias(f"{ident}_text"),
    )


def item_sketches(items: DataFrame, width: int, threshold: Fraction) -> DataFrame:
    """``item_key, width, hash``: the sketch of every item, a row per hash."""
    schema = pa.schema([("item_key", pa.binary()), ("width", pa.int32()), ("hash", pa.list_(pa.int64()))])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in in_slices(batches):
            widths, sketches = [], []
            for text in byte_texts(batch["item_text"]):
                words = plain_words(text)
                widths.append(min(width, len(words)))
                runs = np.unique(run_hashes(hashes.of(words), widths[-1])) if words else np.empty(0, np.uint64)
                sketches.append(runs[: sketch_size(len(runs), threshold)].view(np.int64) if len(runs) else [])
            yield record(schema, batch["item_key"], widths, sketches)

    found = items.mapInArrow(of, "item_key binary, width int, hash array<bigint>")
    return found.select("item_key", "width", F.explode("hash").alias("hash"))


def bit_set(hashes: DataFrame, bits: int) -> np.ndarray:
    """Which of 2^bits ranges of hash values occur in ``hash``: at most 2^bits / 64 rows reach the driver."""
    place = F.shiftrightunsigned("hash", 64 - bits)
    flags = hashes.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    words = flags.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("flags")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["flags"].to_numpy().view(np.uint64)
    return out


def marked(rows: DataFrame, sketches: DataFrame, filter_bits: int | None, texts: Callable) -> DataFrame:
    """``rows`` with ``hits`` (width and hash), the shingles of a row's text that may be in an item's sketch; stored.

    ``texts`` gives the texts of a batch. Single columns (``doc_key, doc_id, doc_text``) are kept of rows with hits only, packed
    rows all. The rows stay where they are: the bit set comes to them.
    """
    if filter_bits is None:
        filter_bits = bits_for(sketches.count())
    flags = bit_set(sketches, filter_bits)
    widths = [r.width for r in sketches.select("width").distinct().collect()]  # 1 to WIDTH
    only_hits = ROW not in rows.columns
    kept = [c for c in rows.columns if c != "text"]
    kind = pa.list_(pa.struct([("width", pa.int32()), ("hash", pa.int64())]))
    shift = np.uint64(64 - filter_bits)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in in_slices(batches):
            sizes, found_widths, found = [], [], []
            for text in texts(batch):
                words = hashes.of(plain_words(text))
                count = 0
                for width in widths:
                    runs = run_hashes(words, width)
                    place = runs >> shift
                    runs = np.unique(runs[(flags[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0])
                    found_widths.append(np.full(len(runs), width, np.int32))
                    found.append(runs)
                    count += len(runs)
                sizes.append(count)
            struct = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate(found_widths or [np.empty(0, np.int32)])),
                    pa.array(np.concatenate(found or [np.empty(0, np.uint64)]).view(np.int64)),
                ],
                ["width", "hash"],
            )
            hits = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), struct).cast(kind)
            out = pa.RecordBatch.from_arrays([*(batch[c] for c in kept), hits], [*kept, "hits"])
            yield out.filter(pa.array(np.array(sizes) > 0)) if only_hits else out

    schema = StructType([*(rows.schema[c] for c in kept), _HITS])
    return lineage_cut(rows.mapInArrow(of, schema))


def candidates(hit: DataFrame, sketches: DataFrame) -> DataFrame:
    """``doc_key, item_key`` of every document (doc_key, hits) that has a shingle of an item's sketch."""
    hits = hit.select("doc_key", F.explode("hits").alias("hit")).select("doc_key", "hit.*")
    return hits.join(sketches, ["width", "hash"]).select("doc_key", "item_key").distinct()


def _shingles(words: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def verified(pairs: DataFrame, width: int, threshold: Fraction) -> DataFrame:
    """The pairs (``doc_key, doc_id, doc_text, item_id, item_text``) that hold, with their counts of shingles."""
    schema = pa.schema(
        [("doc_key", pa.binary()), ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n", pa.int64()), ("matched", pa.int64())]
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words, sets = None, [], {}
        for batch in in_slices(batches):
            rows = []
            for key, doc_id, text, item_id, item in zip(*(batch[c] for c in batch.schema.names), strict=True):
                if key != last:
                    last, words, sets = key, plain_words(text.as_py() or b""), {}
                item_words = plain_words(item.as_py() or b"")
                size = min(width, len(item_words))
                if size not in sets:
                    sets = {**sets, size: _shingles(words, size)}
                wanted = _shingles(item_words, size)
                matched = len(wanted & sets[size])
                if matched >= threshold * len(wanted):
                    rows.append((key.as_py(), doc_id.as_py(), item_id.as_py(), len(wanted), matched))
            yield record(schema, *(zip(*rows, strict=True) if rows else [[]] * 5))

    ordered = pairs.select("doc_key", "doc_id", "doc_text", "item_id", "item_text")
    return ordered.mapInArrow(of, "doc_key binary, doc_id bigint, item_id bigint, n bigint, matched bigint")


def _items(benchmark: DataFrame, item_column: str, item_text: str, width: int, share: Fraction) -> tuple[DataFrame, DataFrame]:
    """Every different item, and the sketches of all."""
    items = lineage_cut(_keyed(benchmark, item_column, item_text, "item").dropDuplicates(["item_key"]))
    return items, lineage_cut(item_sketches(items, width, share))


def _holding(hit: DataFrame, items: DataFrame, sketches: DataFrame, width: int, share: Fraction) -> DataFrame:
    """The documents and items that hold, of documents with hits (doc_key, doc_id, doc_text, hits)."""
    pairs = lineage_cut(candidates(hit, sketches))
    return verified(pairs.join(items, "item_key").join(hit.drop("hits"), "doc_key"), width, share)


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    filter_bits: int | None = None,
) -> DataFrame:
    """``doc_id, item_id, item_shingles, matched, containment`` for every document and item that it holds."""
    share = Fraction(str(threshold))
    items, sketches = _items(benchmark, item_column, item_text, width, share)
    hit = marked(_keyed(docs, id_column, text_column, "doc"), sketches, filter_bits, lambda batch: byte_texts(batch["doc_text"]))
    return _holding(hit, items, sketches, width, share).select(
        "doc_id",
        "item_id",
        F.col("n").alias("item_shingles"),
        "matched",
        (F.col("matched") / F.col("n")).alias("containment"),
    )


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    filter_bits: int | None = None,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    share = Fraction(str(threshold))
    items, sketches = _items(benchmark, item_column, item_text, width, share)
    told = marked(packed_with_text(docs, text_column), sketches, filter_bits, lambda batch: row_texts(batch, text_column))
    # without a hit a document holds nothing, and is not moved
    clean = told.filter(F.size("hits") == 0).select(ROW)
    suspects = told.filter(F.size("hits") > 0).withColumn("doc_key", row_key(field(id_column), field(text_column)))
    hit = suspects.select(
        "doc_key",
        field(id_column).cast("bigint").alias("doc_id"),
        field(text_column).cast("string").cast("binary").alias("doc_text"),
        "hits",
    )
    leaks = lineage_cut(_holding(hit, items, sketches, width, share).select("doc_key").distinct())
    return unpacked(clean.unionByName(suspects.join(leaks, "doc_key", "left_anti").select(ROW)))
