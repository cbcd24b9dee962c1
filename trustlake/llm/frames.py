"""What the operators share: whole rows kept apart from working columns, a key for a row, texts out of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole rows travel in one struct of this name, so no column of theirs can clash with a working column.
ROW = "_row"


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column; ``unpacked`` gives the rows back with every column they had."""
    return docs.select(F.struct("*").alias(ROW))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def field(name: str) -> Column:
    """A column of the packed row."""
    return F.col(ROW)[name]


def packed_with_text(docs: DataFrame, text_column: str) -> DataFrame:
    """``packed`` rows for ``row_texts``: a text column that is a string goes to the workers within its row only."""
    rows = packed(docs)
    if docs.schema[text_column].dataType.typeName() == "string":
        return rows
    return rows.withColumn("text", field(text_column).cast("string"))


def row_texts(batch: pa.RecordBatch, text_column: str) -> Iterator[bytes]:
    """The texts of a batch of ``packed_with_text``, null as empty, one at a time."""
    texts = batch["text"] if "text" in batch.schema.names else batch[ROW].field(text_column)
    return byte_texts(texts.cast(pa.binary()))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def row_key(id_column: Column, text: Column) -> Column:
    """32 bytes that name a row by its id and whole text; a null id or text differs from every other value."""
    ident = F.coalesce(F.concat(F.lit("i"), id_column.cast("string")), F.lit("n"))
    content = F.coalesce(F.concat(F.lit("t"), text.cast("string")), F.lit("n"))
    return F.unhex(F.sha2(F.concat_ws("|", ident, content), 256))


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """The texts of a binary column, null as empty, one at a time."""
    for value in column:
        yield value.as_py() or b""


def in_slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 1 << 25) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``max_bytes`` (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """Columns of plain values or arrays as one batch."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)
