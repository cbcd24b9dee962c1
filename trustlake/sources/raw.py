"""Raw delimited files: all text in, all text kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trustlake.operators.selection import prefix_sums
from trustlake.session import lineage_cut

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"


#: The text of a raw row that cannot be read into the columns; NULL for all others.
MALFORMED = "_malformed"


NO_HEADER = "no such header: "
#: Beside the names in a header: a byte order mark, and blanks.
_MARGINS = "\ufeff \t\r"
_CSV = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}


def _fields_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in (*(f"_c{i}" for i in range(len(columns))), MALFORMED)])


def _physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, _source_file, _block, _line``: lines with the split they come from, and their order inside of it."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )


def _headers(first_records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_source_file, _header, _names``: by file the names in its first record, NULL if they are not ``columns``, and what to
    say of that record then."""
    schema = _fields_schema(columns)
    parsed = F.from_csv(F.btrim("value", F.lit(_MARGINS)), schema.simpleString()[7:-1].replace(":", " "), _CSV)
    read = first_records.select(SOURCE_FILE, F.btrim("value", F.lit(_MARGINS)).alias("_header"), parsed.alias("p"))
    names = F.array(*(F.btrim(F.col(f"p._c{i}"), F.lit(_MARGINS)) for i in range(len(columns))))
    wanted = F.array(*(F.lit(c) for c in sorted(columns)))
    fits = F.col(f"p.{MALFORMED}").isNull() & F.array_sort(names).eqNullSafe(wanted)
    told = F.coalesce(F.col(f"p.{MALFORMED}"), F.concat(F.lit(NO_HEADER), "_header")).alias("_header")
    return lineage_cut(read.select(SOURCE_FILE, told, F.when(fits, names).alias("_names")))


def _placed(rows: DataFrame, headers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (_c0 to the last, _malformed, _source_file) with their fields under the names in their file's header."""
    places = [f"_c{i}" for i in range(len(columns))]
    layouts = headers.select("_names").distinct().limit(2).collect()
    if len(layouts) == 1 and layouts[0]["_names"] is not None:
        # all files have their columns in one order
        at = {name: place for place, name in enumerate(layouts[0]["_names"])}
        return rows.select(
            *(F.when(F.col(MALFORMED).isNull(), F.col(f"_c{at[c]}")).alias(c) for c in columns), MALFORMED, SOURCE_FILE
        )
    # as small as the number of files; Catalyst knows how small
    placed = rows.withColumn("_fields", F.array(*places)).join(headers.drop("_header"), SOURCE_FILE, "left")
    no_header = F.concat(F.lit(NO_HEADER), F.concat_ws(",", "_fields"))
    malformed = F.coalesce(MALFORMED, F.when(F.col("_names").isNull(), no_header))
    field = {c: F.try_element_at("_fields", F.array_position("_names", c).cast("int")) for c in columns}
    named = placed.withColumn("_bad", malformed).select(
        *(F.when(F.col("_bad").isNull(), value).alias(c) for c, value in field.items()),
        F.col("_bad").alias(MALFORMED),
        SOURCE_FILE,
    )
    # a header that does not fit is kept like the rows below it
    unfit = headers.filter("_names IS NULL").select(
        *(F.lit(None).cast("string").alias(c) for c in columns),
        F.col("_header").alias(MALFORMED),
        SOURCE_FILE,
    )
    return named.unionByName(unfit)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """``value, _source_file, _record``: the records of delimited files whose quoted fields may hold line breaks.

    A line begins a record if the quotes before it in its file are even in number. They are counted by split, the splits'
    counts are added up, and inside a split a window goes on from there: any split of any file is read by a task of its
    own. Only lines of records that go over several lines are brought together.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = _physical_lines(spark, path).withColumn("_quotes", quotes.cast("bigint"))
    block = [SOURCE_FILE, "_block"]
    counted = lineage_cut(lines.groupBy(*block).agg(F.sum("_quotes").alias("_quotes")))
    before = lineage_cut(
        prefix_sums(counted, [SOURCE_FILE], "_block", ["_quotes"]).select(*block, F.col("_quotes_before").alias("_open"))
    )
    inside = Window.partitionBy(*block).orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    known = lines.join(before, block).withColumn("_before", F.col("_open") + F.coalesce(F.sum("_quotes").over(inside), F.lit(0)))
    starts = (F.col("_before") % 2 == 0).cast("bigint")
    marked = lineage_cut(known.select("value", *block, "_line", "_quotes", starts.alias("_start")))
    # numbers of records: those that start in earlier splits, and before the line in its own
    per_block = lineage_cut(marked.groupBy(*block).agg(F.sum("_start").alias("_start")))
    offsets = prefix_sums(per_block, [SOURCE_FILE], "_block", ["_start"]).select(*block, F.col("_start_before").alias("_offset"))
    upto = Window.partitionBy(*block).orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.join(lineage_cut(offsets), block).withColumn("_record", F.col("_offset") + F.sum("_start").over(upto) - 1)
    whole = (F.col("_start") == 1) & (F.col("_quotes") % 2 == 0)
    numbered = lineage_cut(numbered.select("value", *block, "_line", "_record", whole.alias("_whole")))
    one = numbered.filter("_whole").select("value", SOURCE_FILE, "_record")
    parts = F.array_sort(F.collect_list(F.struct("_block", "_line", "value")))
    several = (
        numbered.filter("NOT _whole")
        .groupBy(SOURCE_FILE, "_record")
        .agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
        .select("value", SOURCE_FILE, "_record")
    )
    return one.unionByName(several)


def read_raw(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """Every column as text, nothing inferred; quotes inside a field are doubled.

    With ``columns``, the first record of each file says where they are, so files may have them in any order; blanks around
    names do not matter, and rows that look like a header are rows. A row with more or fewer fields, and any row of a file
    whose header does not name exactly these columns, its header included, has NULLs in all of them and its text in
    ``_malformed``. Without ``columns`` the first file's header counts for all.

    ``multi_line`` allows line breaks inside quoted fields. Files are split all the same (without ``columns`` they are not);
    a field that holds a quote must be quoted.
    """
    reader = spark.read.options(**_CSV).option("header", True)
    if columns is None:
        return spark.read.option("escape", '"').option("multiLine", multi_line).option("header", True).csv(path)
    schema = _fields_schema(columns)
    if not multi_line:
        lines = _physical_lines(spark, path).filter("_block = 0")
        first = lines.groupBy(SOURCE_FILE).agg(F.min_by("value", "_line").alias("value"))
        rows = reader.schema(schema).csv(path).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
        return _placed(rows, _headers(first, columns), columns)
    records = _records(spark, path)
    text = F.regexp_replace("value", "\\r$", "")
    fields = F.from_csv(text, schema.simpleString()[7:-1].replace(":", " "), _CSV)
    rows = records.filter("_record > 0").filter(F.trim(text) != "").select(fields.alias("f"), SOURCE_FILE).select("f.*", SOURCE_FILE)
    return _placed(rows, _headers(records.filter("_record = 0"), columns), columns)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add when the row was loaded and the file it came from, which a frame straight from a file source can tell."""
    known = [] if SOURCE_FILE in df.columns else [F.col("_metadata.file_path").alias(SOURCE_FILE)]
    return df.select("*", F.current_timestamp().alias(INGESTED_AT), *known)


def write_raw(df: DataFrame, path: str) -> None:
    """Delimited text that ``read_raw`` reads back unchanged (except that empty text becomes NULL)."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
