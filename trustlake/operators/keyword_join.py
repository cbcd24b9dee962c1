"""Keyword rules whose words are a table: one index of letter groups instead of one search per word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlake.operators.selection import prefix_sums
from trustlake.session import lineage_cut

#: Letters of a group; shorter words are looked up by groups of their own length.
GROUP = 4
KEY = "_text_key"
#: Words that may be in a text and meet it in one row.
CHUNK = 4096


def groups_of(text: Column, size: int) -> Column:
    """All groups of ``size`` neighbouring letters, each once, in one pass over the text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def keyword_index(words: DataFrame) -> DataFrame:
    """``group, size, word, label, rank``: every word under one of its groups, the one that fewest words of the table have.

    ``words`` has columns word, label, rank; the same word may have several rows, of which the one with the least rank, then
    label, counts. Missing and empty words and those without a rank are in no text.
    """
    usable = words.select("word", "label", "rank").filter("length(word) > 0 AND rank IS NOT NULL")
    best = usable.groupBy("word").agg(F.min(F.struct("rank", "label")).alias("_best"))
    size = F.least(F.length("word"), F.lit(GROUP))
    groups = F.coalesce(*(F.when(size == n, groups_of(F.col("word"), n)) for n in range(1, GROUP + 1)))
    spread = lineage_cut(best.select("word", "_best.*", size.alias("size"), F.explode(groups).alias("group")))
    common = spread.groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
    rarest = spread.join(common, "group").groupBy("word").agg(F.min(F.struct("_n", "group")).alias("_rare"))
    return spread.join(rarest, "word").filter("group = _rare.group").select("group", "size", "word", "label", "rank")


def _first_of(texts: DataFrame, index: DataFrame, found: Column) -> DataFrame:
    """(key, _first): rank and label of the first word that is in the text.

    The words are numbered by rank and label. The candidates of a text meet it as arrays of at most ``CHUNK``, and are searched
    in order until the first one that is in it.
    """
    order = F.struct("rank", F.col("label").isNotNull().alias("known"), "label", "word").alias("order")
    numbered = prefix_sums(index.select("group", order, F.lit(1).cast("bigint").alias("one")), [], "order", ["one"])
    places = lineage_cut(numbered.select("group", "order.word", "order.label", "order.rank", F.col("one_before").alias("place")))
    groups = texts.select(KEY, F.explode(found).alias("group"))
    maybe = groups.join(places.select("group", F.struct("place", "word").alias("candidate")), "group")
    chunk = F.floor(F.col("candidate.place") / F.lit(CHUNK)).alias("_chunk")
    chunks = maybe.groupBy(KEY, chunk).agg(F.sort_array(F.collect_list("candidate")).alias("_candidates"))
    hit = F.aggregate(
        "_candidates",
        F.lit(None).cast("bigint"),
        lambda seen, c: F.when(seen.isNotNull(), seen).when(F.contains(F.col("_text"), c["word"]), c["place"]),
    )
    best = chunks.join(texts, KEY).select(KEY, hit.alias("place")).groupBy(KEY).agg(F.min("place").alias("place"))
    named = places.select("place", F.struct("rank", F.col("label").alias("_found")).alias("_first"))
    return best.join(named, "place").select(KEY, "_first")


def with_first_label(
    df: DataFrame, words: DataFrame, text: str = "text", label: str = "label", default: str = "other"
) -> DataFrame:
    """Add, as column ``label``, the label of the word of least rank (then label) that occurs anywhere in the lower-case text.

    Same answer as ``functions.keywords.first_label`` with the table's words in order of rank, whatever the number of words:
    each text looks up its own groups of letters, only words with such a group are searched in it, and the search decides.
    Equal texts are read once. Of a text only its distinct groups travel, and itself once to every ``CHUNK`` words that may be
    in it; they are searched in order, up to the first one found.

    Missing and empty texts have the default, like texts without any word. Rows keep all their columns; one already called
    like the new one is replaced.
    """
    if label == text:
        raise ValueError("the label needs a column of its own")
    lowered = F.lower(F.col(text))
    keyed = df.drop(label).withColumn(KEY, F.sha2(lowered, 256))
    texts = lineage_cut(df.select(F.sha2(lowered, 256).alias(KEY), lowered.alias("_text")).filter("_text != ''").distinct())
    index = lineage_cut(keyword_index(words))
    sizes = [row["size"] for row in index.select("size").distinct().collect()]  # at most GROUP
    if not sizes:
        return keyed.drop(KEY).withColumn(label, F.lit(default))
    found = F.flatten(F.array(*(groups_of(F.col("_text"), n) for n in sorted(sizes))))
    first = lineage_cut(_first_of(texts, index, found))
    labelled = keyed.join(first.select(KEY, F.struct("_first._found").alias("_first")), KEY, "left")
    answer = F.when(F.col("_first").isNotNull(), F.col("_first._found")).otherwise(F.lit(default))
    return labelled.select(*(F.col(c) for c in keyed.columns if c != KEY), answer.alias(label))
