"""Best-fit packing of documents into sequences of bounded length, by hierarchical residual rounds.

A document longer than a sequence is cut into pieces of a sequence's length and a shorter last one; no other document is
cut. Pieces are packed in rounds. In the first, every task packs its pieces best-fit, longest first, and emits the bins that
are full or nearly so. The underfull bins are the items of the next round, dealt to an eighth of the tasks, and so on until
one task is left or hardly any bins have met in a round. After best fit a task has at most one bin that is half full or
less, so later rounds find few partners. A task never takes more than about ``task_rows``
pieces. Bins hold whole pieces only, and every round's result is a stored table.

Defined results: a null text is empty and has the end id only. Repeated rows, and rows with null ids, are packed one by one.
An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.encoding import ID, encoder
from trustlake.llm.frames import byte_texts, in_slices, record
from trustlake.session import lineage_cut

LENGTH = 2_048
TASK_ROWS = 200_000
FAN_IN = 8
#: A bin with at most this share of free places is emitted at once.
NEARLY_FULL = 1 / 128
#: A later round in which fewer than one in so many bins has met another is the last.
LEAST_GAIN = 1_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = f"{PIECES}, sequence_id bigint, offset bigint, done boolean"
_TYPES = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
_PACKED = pa.schema([*_TYPES, ("sequence_id", pa.int64()), ("offset", pa.int64()), ("done", pa.bool_())])


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row per piece: its document, number, first id's place in the document, length and checksum of ids."""
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text")
    )
    schema = pa.schema(_TYPES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, step = encoder(tokenizer), np.array([end_id], ID).tobytes(), length * ID.itemsize
        for batch in in_slices(batches):
            found = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), byte_texts(batch["text"]), strict=True):
                ids = encode.ids(text.decode("utf-8", "replace")) + end
                for number, start in enumerate(range(0, len(ids), step)):
                    part = ids[start : start + step]
                    found.append((doc_id, number, number * length, len(part) // ID.itemsize, zlib.crc32(part)))
            yield record(schema, *zip(*found, strict=True))

    return rows.mapInArrow(cut, PIECES)


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per item its bin and place there, longest items first; and every bin's filling."""
    bins = np.empty(len(sizes), np.int64)
    places = np.empty(len(sizes), np.int64)
    filled: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms = 0  # bit r is set when some bin has exactly r free places
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = length, len(filled)
            filled.append(0)
        bins[item], places[item] = chosen, filled[chosen]
        filled[chosen] += size
        if room > size:
            with_room[room - size].append(chosen)
            rooms |= 1 << (room - size)
    return bins, places, np.array(filled, np.int64)


def _round(rows: DataFrame, number: int, last: bool, length: int, nearly_full: float) -> DataFrame:
    """Pack each partition's bins (rows of equal ``sequence_id``; null: a bin of its own) and store the result."""
    slack = int(length * nearly_full)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [b for b in batches if b.num_rows]
        if not given:
            return
        table = pa.Table.from_batches(given)
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        if number:
            _, item = np.unique(table["sequence_id"].to_numpy(), return_inverse=True)
        else:
            item = np.arange(table.num_rows)
        sizes = np.bincount(item, table["length"].to_numpy()).astype(np.int64)
        bins, places, filled = best_fit(sizes, length)
        bin_of = bins[item]
        # unique over rounds, partitions and bins: 11, 24 and 28 bits
        ids = (number << 52 | TaskContext.get().partitionId() << 28) + bin_of
        done = last | (length - filled[bin_of] <= slack)
        offset = places[item] + pc.fill_null(table["offset"], 0).to_numpy()
        columns = [*(table[n].combine_chunks() for n, _ in _TYPES), pa.array(ids), pa.array(offset), pa.array(done)]
        whole = record(_PACKED, *columns)
        for start in range(0, whole.num_rows, 50_000):
            yield whole.slice(start, 50_000)

    return lineage_cut(rows.mapInArrow(pack, PACKED))


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
    task_rows: int = TASK_ROWS,
    nearly_full: float = NEARLY_FULL,
) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    items = lineage_cut(pieces(docs, tokenizer, end_id, length, id_column, text_column))
    open_rows = items.withColumns({"sequence_id": F.lit(None).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    n_rows = items.count()
    n_bins, tasks, number, done = n_rows, max(1, ceil(n_rows / task_rows)), 0, []
    dealt = open_rows.repartition(tasks)
    while True:
        packed = _round(dealt, number, tasks == 1, length, nearly_full)
        done.append(packed.filter("done"))
        if tasks == 1:
            break
        left = packed.filter("NOT done")
        n_left, bins_left = left.agg(F.count("*"), F.countDistinct("sequence_id")).first()
        if number and (n_bins - bins_left - _closed(packed)) * LEAST_GAIN < n_bins:
            done.append(left)
            break
        number, n_bins = number + 1, bins_left
        tasks = max(1, ceil(tasks / FAN_IN), ceil(n_left / task_rows))
        dealt = left.drop("done").repartition(tasks, "sequence_id")
    return reduce(DataFrame.unionByName, done).drop("done")


def _closed(packed: DataFrame) -> int:
    """How many bins a round has emitted."""
    return packed.filter("done").agg(F.countDistinct("sequence_id")).first()[0]
