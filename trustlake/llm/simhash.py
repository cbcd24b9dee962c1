"""Near duplicates by SimHash and covering locality-sensitive hashing.

A document's fingerprint has a bit set where more than half of its shingles' hashes have it. Documents whose fingerprints
differ in at most ``radius`` bits are linked; the components of that relation are the groups. Only distinct fingerprints
are compared. Each goes into one table per covering mask (``masks``), which loses no link. A bucket that holds many
fingerprints is dealt out again by covering masks over the bits that its own mask leaves open: with 64 bits and radius 2 at
most 12 bits stay open, hence at most 4,096 fingerprints meet in one second-level bucket. Inside a bucket the links are
replaced by a star per component, so a bucket never gives more rows than it has fingerprints.

Defined results: a null text is empty; a text without words has fingerprint zero and is linked like any other; fewer words
than a shingle make one shingle. A component's id is its smallest document id, nulls aside (null if all are null).
Repeated rows give repeated rows. An empty table gives an empty table. Other columns are ignored by ``near_groups`` and
kept by ``one_per_group``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.components import components
from trustlake.llm.frames import ROW, byte_texts, field, in_slices, packed, record, row_key, unpacked
from trustlake.llm.masks import covering_masks, free_bits, signed
from trustlake.session import lineage_cut

BITS = 64
SEED = 42
#: A bucket with more distinct fingerprints is dealt out again.
BUCKET = 2_048


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased words, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - size] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    cut = zip(starts, ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(line[a:b], SEED) for a, b in cut), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes, as a signed number."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = np.ascontiguousarray(hashes[start : start + (1 << 16)]).astype("<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little") if len(hashes) else np.zeros(8, np.uint8)
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """``key, doc_id, fp`` per row; the key names the row by id and text."""
    rows = docs.select(
        row_key(F.col(id_column), F.col(text_column)).alias("key"),
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text_column).cast("string").cast("binary").alias("text"),
    )
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("fp", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            prints = [fingerprint(shingle_hashes(text, shingle)) for text in byte_texts(batch["text"])]
            yield record(schema, batch["key"], batch["doc_id"], prints)

    return rows.mapInArrow(of, "key binary, doc_id bigint, fp bigint")


def _bucket_stars(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Members other than the first of each component in a bucket, and their component's first member."""
    root = np.full(len(prints), -1)
    for first in range(len(prints)):
        if root[first] >= 0:
            continue
        root[first], reached = first, [first]
        while reached:
            near = np.flatnonzero((np.bitwise_count(prints ^ prints[reached.pop()]) <= radius) & (root < 0))
            root[near] = first
            reached.extend(near.tolist())
    other = root != np.arange(len(prints))
    return prints[other], prints[root[other]]


def _links(keyed: DataFrame, by: list[str], radius: int) -> DataFrame:
    """``a, b`` edges inside the buckets named by the columns ``by``; a bucket's rows arrive together and in order."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    dealt = keyed.select(*by, "fp").repartition(*by).sortWithinPartitions(*by)

    def link(table: pa.Table) -> pa.RecordBatch:
        columns = [table[c].to_numpy() for c in by]
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        bounds = np.append(np.flatnonzero(change), table.num_rows)
        prints = table["fp"].to_numpy()
        found = [_bucket_stars(np.unique(prints[x:y]).view(np.uint64), radius) for x, y in zip(bounds, bounds[1:]) if y - x > 1]
        a = np.concatenate([f[0] for f in found] or [np.empty(0, np.uint64)]).view(np.int64)
        b = np.concatenate([f[1] for f in found] or [np.empty(0, np.uint64)]).view(np.int64)
        return record(schema, pa.array(a), pa.array(b))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            last = [waiting[c][-1].as_py() for c in by]
            same = np.ones(waiting.num_rows, bool)
            for c, value in zip(by, last, strict=True):
                same &= waiting[c].to_numpy() == value
            open_from = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if open_from:
                yield link(waiting.slice(0, open_from))
                waiting = waiting.slice(open_from).combine_chunks()
        if waiting is not None and waiting.num_rows:
            yield link(waiting)

    return dealt.mapInArrow(of, "a bigint, b bigint")


def _masked(masks: list[int], table: str, key: str):
    """One row per mask: its number and the fingerprint under it."""
    choices = [F.struct(F.lit(n).alias(table), F.col("fp").bitwiseAND(F.lit(signed(m))).alias(key)) for n, m in enumerate(masks)]
    return F.explode(F.array(*choices)).alias("m")


def near_links(prints: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a, b`` that connect distinct fingerprints exactly as all pairs within ``radius`` bits would.

    ``prints`` has one row per distinct ``fp``.
    """
    bits = range(BITS)
    masks = covering_masks(bits, radius)
    keyed = prints.select("fp", _masked(masks, "t", "k")).select("fp", "m.*")
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1")
    shared = lineage_cut(keyed.join(sizes, ["t", "k"]))
    small = shared.filter(F.col("n") <= bucket).select("t", "k", "fp")
    # the free bits differ from table to table, and so do the second masks
    second = [covering_masks(free_bits(m, bits), radius) for m in masks]
    choices = [
        F.when(F.col("t") == t, F.array(*(F.lit(signed(m)) for m in sub))) for t, sub in enumerate(second)
    ]
    hot = shared.filter(F.col("n") > bucket).select("t", "k", "fp", F.posexplode(F.coalesce(*choices)).alias("t2", "mask"))
    split = hot.select("t", "k", "t2", F.col("fp").bitwiseAND(F.col("mask")).alias("k2"), "fp")
    edges = _links(small, ["t", "k"], radius)
    return edges.unionByName(_links(split, ["t", "k", "t2", "k2"], radius))


def _grouped(docs: DataFrame, id_column: str, text_column: str, shingle: int, radius: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """The stored fingerprints, and ``fp, root, component_id`` per distinct fingerprint."""
    rows = lineage_cut(fingerprints(docs, id_column, text_column, shingle))
    distinct = lineage_cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(near_links(distinct.select("fp"), radius, bucket))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows, rooted.join(least, "root").select("fp", "root", "component_id")


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    radius: int = 2,
    bucket: int = BUCKET,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``."""
    rows, groups = _grouped(docs, id_column, text_column, shingle, radius, bucket)
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.drop("key").join(groups, "fp").select("doc_id", shown, "component_id")


def one_per_group(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    radius: int = 2,
    bucket: int = BUCKET,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that lead their group: smallest id, then smallest key.

    Rows that agree in id and text are one document; one of them stays.
    """
    rows, groups = _grouped(docs, id_column, text_column, shingle, radius, bucket)
    # nulls last, then by key: one hex text per row, so that the least can be taken by a plain aggregate
    by_id = F.coalesce(F.lpad(F.hex(F.col("doc_id").bitwiseXOR(F.lit(-(2**63)))), 16, "0"), F.lit("~"))
    placed = rows.join(groups, "fp").select("root", F.concat(by_id, F.hex("key")).alias("place"))
    leaders = placed.groupBy("root").agg(F.min("place").alias("lead"))
    keys = leaders.select(F.unhex(F.substring("lead", -64, 64)).alias("key"))
    whole = packed(docs)
    keyed = whole.withColumn("key", row_key(field(id_column), field(text_column)))
    kept = keyed.join(keys, "key", "left_semi")
    repeated = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    repeated = lineage_cut(repeated)
    if repeated.isEmpty():
        return unpacked(kept.select(ROW))
    several = kept.join(repeated, "key", "left_semi").withColumn("pick", F.xxhash64(F.to_json(ROW)))
    first = several.groupBy("key").agg(F.max("pick").alias("pick"))
    chosen = several.join(first, ["key", "pick"], "left_semi").dropDuplicates(["key"])
    return unpacked(kept.join(repeated, "key", "left_anti").select(ROW).unionByName(chosen.select(ROW)))
