"""How filters of documents overlap: what each removes in every order in which they may be applied.

Five filters look at whole texts. A to D follow from the text alone; E fails a document whose text an earlier document
has, table-wide, wherever that one ends up. E is an existential self-join: a left-semi join on the text's hash, the exact
text and a smaller id. Its right side is folded to the least id of every text before it is joined, so that a group of
copies, however large, never pairs up: each copy meets one row. The ids that E fails are put under those that the others
fail, and the failures of a document become one combination of bits. All 600 rows of a part come from the counts of its
at most 32 combinations, so that nothing that grows with the documents is touched once per order.

Defined results: a null text is an empty text (it fails A, not B, C or D; empty texts are identical to each other). A null id is
neither smaller nor larger than another: such documents never fail E, nor make another fail it. Rows that repeat an id and
a text are documents of their own, each of them is counted; they do not make each other fail E. A null part and an empty one are
the same part. A document is good, or toxic, if any row of the labels with its id says so. An empty table gives no parts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.llm.frames import text_or_empty

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
WORD = r"[^\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
STATED = ["quality", "toxic"]


def own_failures(text: Column) -> Column:
    """The bits of the filters that the text alone fails."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = (
        count < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * count,
        100 * capitals.cast("bigint") > MOST_CAPITALS * F.length(text),
        text.rlike(r"[#$%&*|]"),
    )
    return sum((F.when(fail, 1 << bit).otherwise(0) for bit, fail in enumerate(fails)), F.lit(0))


def later_copies(rows: DataFrame) -> DataFrame:
    """Those of ``rows`` (doc_id, hash, text and more) whose text a row with a smaller id has."""
    first = rows.groupBy(F.col("hash").alias("first_hash"), F.col("text").alias("first_text")).agg(
        F.min("doc_id").alias("first_id")
    )
    identical = (F.col("hash") == F.col("first_hash")) & (F.col("text") == F.col("first_text"))
    return rows.join(first, identical & (F.col("first_id") < F.col("doc_id")), "left_semi")


def failures(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source"
) -> DataFrame:
    """``doc_id, hash, part, fails, documents``: the combination of filters that equal documents fail, and their number.

    Documents are equal if id, text and part are.
    """
    text = text_or_empty(F.col(text_column))
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("hash"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    document = ["doc_id", "hash", "part"]
    all_ids = rows.select(*document, own_failures(F.col("text")).alias("fail"), F.lit(1).alias("one"))
    copied = later_copies(rows).select(*document).distinct()
    marked = all_ids.unionByName(copied.select(*document, F.lit(COPY).alias("fail"), F.lit(0).alias("one")))
    # equal documents fail alike: any of their bits, and once the bit of E
    return marked.groupBy(*document).agg(F.bit_or("fail").alias("fails"), F.sum("one").alias("documents"))


def combinations(failed: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``part, fails, documents, good, toxic``: the documents of each combination of failures."""
    stated = (
        labels.select(F.col(id_column).cast("bigint").alias("doc_id"), *(F.col(c).cast("int").alias(c) for c in STATED))
        .groupBy("doc_id")
        .agg(*(F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in STATED))
    )
    told = failed.join(stated, "doc_id", "left")
    return told.groupBy("part", "fails").agg(
        F.sum("documents").alias("documents"),
        *(F.sum(F.coalesce(F.col(c), F.lit(0)) * F.col("documents")).alias(n) for c, n in zip(STATED, ["good", "toxic"], strict=True)),
    )


def _bits_of(letters: Column) -> Column:
    return sum((F.when(F.contains(letters, F.lit(f)), 1 << bit).otherwise(0) for bit, f in enumerate(FILTERS)), F.lit(0))


def _total(value, wanted) -> Column:
    """The sum of ``value`` of the combinations that ``wanted`` says."""
    combos = F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))
    return F.aggregate(
        F.filter(combos, wanted), F.lit(0).cast("bigint"), lambda total, combo: total + value(combo).cast("bigint")
    )


def _counts(name: str):
    return lambda combo: F.get(F.col(name), combo)


def removals(combos: DataFrame) -> DataFrame:
    """What every step of every order of the filters keeps and removes, per part, from the counts of ``combinations``."""
    sums = {
        n: F.array(*(F.coalesce(F.sum(F.when(F.col("fails") == c, F.col(n))), F.lit(0)) for c in range(1 << len(FILTERS))))
        for n in ("documents", "good", "toxic")
    }
    parts = combos.groupBy("part").agg(*(column.alias(n) for n, column in sums.items()))
    orders = parts.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS))))
    steps = orders.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    placed = steps.withColumns(
        {
            "own": _bits_of(F.substring("filter_order", F.col("step"), F.lit(1))),
            "earlier": _bits_of(F.substring("filter_order", F.lit(1), F.col("step") - 1)),
        }
    )
    own, earlier = F.col("own"), F.col("earlier")

    def fails(combo, bits):
        return combo.bitwiseAND(bits) != 0

    def here(combo):
        return fails(combo, own) & ~fails(combo, earlier)

    def first_of(combo):
        """Documents times orders: of the orders, one in as many as a document fails filters begins with this one."""
        return F.get(F.col("documents"), combo) * F.lit(len(ORDERS)) / F.bit_count(combo)

    return placed.select(
        "part",
        "filter_order",
        "step",
        _total(_counts("documents"), lambda c: ~fails(c, own) & ~fails(c, earlier)).alias("kept"),
        _total(_counts("documents"), here).alias("removed"),
        _total(_counts("documents"), lambda c: fails(c, own) & fails(c, earlier)).alias("redundant"),
        _total(_counts("documents"), lambda c: c == own).alias("unique_fails"),
        _total(_counts("good"), here).alias("good_lost"),
        _total(_counts("toxic"), here).alias("toxic_lost"),
        _total(first_of, lambda c: fails(c, own)).alias("shapley"),
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "source",
) -> DataFrame:
    """One row per part, order of the filters and step; all counts are of documents of the part."""
    return removals(combinations(failures(docs, id_column, text_column, part_column), labels, id_column))
