"""Token ids as flat binary files, written and read by Spark tasks.

Layout of a folder: per part a ``.bin`` file of unsigned little-endian integers (16 bits where the vocabulary allows, else
32), an ``.idx`` file of 64-bit offsets (one more than the part has documents, counted in ids from the part's start), and a
``.doc`` file with the documents' ids. A manifest table names the parts in order and their sizes; a part's base, the number
of ids before it, is the prefix sum of the sizes. Parts hold ranges of document ids, so that the whole is in ascending order
(null ids first; equal ids by text hash). Reading maps the files into memory where the folder is a mounted one.

A task writes under a name of its own and reports it when all is written: files of lost attempts are never in the manifest.
Inside the order no id can fill a part: ranges are cut by id, then text hash, then row number. However few partitions the
session shuffles into, a part holds about 64 MB of texts, so a task's memory does not grow with the table.

Defined results: a null text is empty; an empty text has the end id only. Repeated rows are separate documents. An empty
table gives no parts and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trustlake.llm.encoding import ID, encoder
from trustlake.llm.frames import byte_texts, in_slices, record
from trustlake.session import lineage_cut

DOCUMENT = np.dtype([("id", "<i8"), ("known", "u1")])
#: Bytes of text to a part where the session's number of partitions would make larger ones, and what a document counts besides.
PART_BYTES, DOCUMENT_BYTES = 1 << 26, 256
MANIFEST = "part int, name string, width int, docs bigint, ids bigint"


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the folder's path there."""
    return fs.FileSystem.from_uri(folder)


def address(spark: SparkSession, folder: str, held: str | None = None) -> str:
    """A folder's whole address: a path without a scheme lies where Spark would look for it, in the default file system.

    On a cluster whose session does not name that one, Spark itself says where ``held`` lies, a file in the folder; without
    one, a row is stored there first.
    """
    if re.match(r"[a-z][a-z0-9+.-]*:", folder):
        return folder
    default = spark.conf.get("spark.hadoop.fs.defaultFS", None)
    if default is None:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            return _asked(spark, folder, held)
        default = "file://"
    return default.rstrip("/") + folder if default != "file://" else f"file://{folder}"


def _asked(spark: SparkSession, folder: str, held: str | None) -> str:
    """The folder's address as Spark's reader gives it for a file in it; only what is no ASCII is left to be quoted."""
    if held is None:
        held = f"address-{uuid4().hex}"
        spark.range(1).write.parquet(f"{folder}/{held}")
    file = spark.read.format("binaryFile").load(f"{folder}/{held}").inputFiles()[0]
    return quote(file[: file.rindex(f"/{held}")], safe="%:/?#[]@!$&'()*+,;=")


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write the files into ``folder``, which all executors must reach, and return the manifest."""
    folder = address(docs.sparkSession, folder)
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text")
    )
    order = ["doc_id", "hash", "row"]
    size = rows.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + DOCUMENT_BYTES)).first()[0] or 0
    parts = -(-size // PART_BYTES)
    more = [parts] if parts > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    ordered = (
        rows.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(*more, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    schema = pa.schema([("part", pa.int32()), ("name", pa.string()), ("width", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width = 2 if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], ID).tobytes()
        part = TaskContext.get().partitionId()
        store, path = _place(folder)
        name = f"part-{part:06d}-{uuid4().hex}"
        offsets, known, out = [0], [], None
        for batch in in_slices(batches):
            if out is None:
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}.bin")
            for doc_id, text in zip(batch["doc_id"].to_pylist(), byte_texts(batch["text"]), strict=True):
                ids = np.frombuffer(encode.ids(text.decode("utf-8", "replace")) + end, ID)
                out.write(ids.astype(f"<u{width}").tobytes())
                offsets.append(offsets[-1] + len(ids))
                known.append((doc_id or 0, doc_id is not None))
        if out is not None:
            out.close()
            for ending, values in ((".idx", np.array(offsets, "<i8")), (".doc", np.array(known, DOCUMENT))):
                with store.open_output_stream(f"{path}/{name}{ending}") as side:
                    side.write(values.tobytes())
            yield record(schema, [part], [name], [width], [len(known)], [offsets[-1]])

    return lineage_cut(ordered.mapInArrow(write, MANIFEST))


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``, the number of ids in the parts before: one row per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _documents(folder: str, name: str, width: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """Id, start in the part, and token ids of every document of a part."""
    store, path = _place(folder)

    def opened(ending: str) -> pa.NativeFile:
        file = f"{path}/{name}{ending}"
        return pa.memory_map(file) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(file)

    with opened(".idx") as index, opened(".doc") as named, opened(".bin") as flat:
        offsets = np.frombuffer(index.read_buffer(), "<i8")
        known = np.frombuffer(named.read_buffer(), DOCUMENT)
        for document, start, stop in zip(known, offsets, offsets[1:], strict=False):
            ids = np.frombuffer(flat.read_at(int(stop - start) * width, int(start) * width), f"<u{width}")
            yield int(document["id"]) if document["known"] else None, int(start), ids


def _read(manifest: DataFrame, folder: str, last: pa.Field, value) -> DataFrame:
    """``doc_id, start, n_tokens`` and ``value`` of the ids, one task per part."""
    first = manifest.first()
    if first is not None:
        folder = address(manifest.sparkSession, folder, f"{first['name']}.idx")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                rows, size = [], 0
                for doc_id, start, ids in _documents(folder, part["name"], part["width"]):
                    rows.append((doc_id, part["base"] + start, len(ids), value(ids)))
                    size += len(ids)
                    if size >= 1 << 20 or len(rows) >= 10_000:
                        yield record(schema, *zip(*rows, strict=True))
                        rows, size = [], 0
                if rows:
                    yield record(schema, *zip(*rows, strict=True))

    kind = "array<bigint>" if pa.types.is_list(last.type) else "bigint"
    parts = with_bases(manifest).repartition(max(1, manifest.count()), "part")
    return parts.mapInArrow(read, f"doc_id bigint, start bigint, n_tokens bigint, {last.name} {kind}")


def read_token_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files."""
    return _read(manifest, folder, pa.field("ids", pa.list_(pa.int64())), lambda ids: ids.astype(np.int64))


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files; the crc is over 32-bit ids whatever the files' width."""
    return _read(manifest, folder, pa.field("ids_crc32", pa.int64()), lambda ids: zlib.crc32(ids.astype(ID).tobytes()))
