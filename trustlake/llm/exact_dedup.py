"""Exact deduplication by skew-safe combining, in DataFrame functions only.

Texts count as equal when they are identical without white space. Copies meet in three stages, each of which groups by
the digest *and* the whole content: on the map side, then by digest and a salt, then globally over the salts' winners.
A group of copies, however large, thus sends one row per map task and salt to the second stage and one row per salt to
the third.

Defined results: a null text is an empty text; empty texts are copies of each other. The row with the most code points
in its original text wins, then the smallest id; a null id loses against any other. Rows that repeat an id with equally
long, equal texts are one document: all are marked kept in ``classify``, and ``without_copies`` returns one of them.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.frames import ROW, field, packed, text_or_empty, unpacked
from trustlake.session import lineage_cut

SALTS = 16
# rank = code points * SPAN + what the id adds: 1 (largest id) to 2^64 (smallest), 0 for a null id
SPAN = 2**64 + 1
ID_TOP = 2**63


def _exact(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def content_of(text: Column) -> Column:
    """The text without white space."""
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", "")


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def rank_of(text: Column, ident: Column) -> Column:
    """A number that is larger for more code points, then for a smaller id."""
    length = F.length(text_or_empty(text)).cast("decimal(10,0)")
    by_id = F.coalesce(_exact(ID_TOP) - ident.cast("decimal(20,0)"), _exact(0))
    return (length * _exact(SPAN) + by_id).cast("decimal(34,0)")


def id_of(rank: Column) -> Column:
    """The id in a rank."""
    by_id = rank % _exact(SPAN)
    return F.when(by_id > 0, (_exact(ID_TOP) - by_id).cast("bigint"))


def _combined(rows: DataFrame, salts: int) -> DataFrame:
    """One row per digest and content: the best rank and the number of rows."""
    best = (F.max("rank").alias("rank"), F.sum("size").alias("size"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("rank"), F.lit(salts))).withColumn("size", F.lit(1).cast("bigint"))
    local = salted.groupBy("digest", "salt", "content").agg(*best)
    return local.repartition("digest").groupBy("digest", "content").agg(*best)


def _marked(rows: DataFrame, salts: int) -> DataFrame:
    """``rows`` (digest, content, rank and more) with their group's ``best`` rank and ``size``.

    Contents have been compared in full before: where a digest stands for one content, as a good digest always does,
    its rows are joined by the digest alone; rows of any other digest are joined by digest and content.
    """
    groups = _combined(rows.select("digest", "content", "rank"), salts)
    by_digest = lineage_cut(
        groups.groupBy("digest").agg(F.max("rank").alias("best"), F.max("size").alias("size"), F.count("*").alias("contents"))
    )
    clear = by_digest.filter("contents = 1").select("digest", "best", "size")
    marked = rows.drop("content").join(clear, "digest")
    shared = by_digest.filter("contents > 1").select("digest")
    if shared.isEmpty():
        return marked
    exact = groups.join(shared, "digest", "left_semi").select(
        "digest", "content", F.col("rank").alias("best"), F.col("size")
    )
    return marked.unionByName(rows.join(exact, ["digest", "content"]).drop("content"))


def classify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Every document, dropped ones too: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    content = content_of(F.col(text_column))
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        sha256(content).alias("text_sha256"),
        digest(content).alias("digest"),
        content.alias("content"),
        rank_of(F.col(text_column), F.col(id_column)).alias("rank"),
    )
    if digest is sha256:
        rows = rows.drop("text_sha256")
    marked = _marked(rows, salts)
    return marked.select(
        "doc_id",
        id_of(F.col("best")).alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("rank") == F.col("best")).alias("kept"),
        (F.col("digest") if digest is sha256 else F.col("text_sha256")).alias("text_sha256"),
    )


def without_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", salts: int = SALTS
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that win their group."""
    text, ident = field(text_column), field(id_column)
    rows = packed(docs).select(
        ROW, sha256(content_of(text)).alias("digest"), content_of(text).alias("content"), rank_of(text, ident).alias("rank")
    )
    won = _marked(rows, salts).filter("rank = best").select(ROW, "digest", "rank")
    # the same id twice with equal texts: only then can two rows win
    repeated = lineage_cut(
        rows.select("digest", "rank").groupBy("digest", "rank").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    )
    if repeated.isEmpty():
        return unpacked(won)
    # of such rows the one with the largest row hash, then any: rows that agree in that are equal
    several = won.join(repeated, "digest", "left_semi").withColumn("pick", F.xxhash64(F.to_json(ROW)))
    first = several.dropDuplicates(["digest", "pick"]).groupBy("digest").agg(F.max("pick").alias("pick"))
    chosen = several.join(first, ["digest", "pick"], "left_semi").dropDuplicates(["digest"])
    return unpacked(won.join(repeated, "digest", "left_anti").select(ROW).unionByName(chosen.select(ROW)))
