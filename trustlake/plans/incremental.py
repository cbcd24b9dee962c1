"""Runs that read only the raw files that are new, and give the tables of a run over all files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trustlake.operators.bounded import few_rows
from trustlake.operators.dedupe import dedupe
from trustlake.operators.rules import MAX_QUARANTINE_RATE, Ledger, observe_ledger
from trustlake.plans.datasets import CLAIMS, POLICIES, Dataset, judge, rules_of, typed
from trustlake.plans.medallion import Layers, Outcome, RowsLostError, build_gold, publish_silver, save_report
from trustlake.session import lineage_cut
from trustlake.sources.raw import MALFORMED, SOURCE_FILE, read_raw, with_lineage
from trustlake.sources.storage import GOOD

#: Months are the unit that is rewritten; rows without a day are filed together.
PERIOD, NO_PERIOD = "_period", "none"
FILE_KEY = "_file"
TAKEN_SCHEMA = "dataset string, file string, length long, modified timestamp, rows long, run_id string"
PUBLISHED_SCHEMA = "run_id string"


class ChangedFileError(RuntimeError):
    """A file that was taken before has other contents now; nothing was read."""


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, file, length, modified``: the files below a folder; of their contents nothing is read."""
    found = spark.read.format("binaryFile").load(path)
    return found.select(
        "path", F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified")
    )


def _literal(path: str) -> str:
    """A path as the reader's pattern that matches only itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _keyed(spec: Dataset) -> Column:
    return reduce(and_, (F.col(k).isNotNull() for k in spec.key))


class KeptRows:
    """Between runs, for each dataset: the files taken, and the typed row that each key has so far.

    A key's row lies in the month it was first filed under and never moves, so a run rewrites the months of the keys it
    brings and no other. Rows without a key are no copies of each other; they lie in one folder per raw file. Every step of a
    run that was broken off can be done again with the same result: the larger of two rows is the same however often they are
    compared, folders are overwritten, and files count as taken last.

    One run at a time writes to a folder.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self._log = f"{self.base}/taken"
        self._published = f"{self.base}/published"
        few_rows(spark, [], TAKEN_SCHEMA).write.mode("ignore").parquet(self._log)
        few_rows(spark, [], PUBLISHED_SCHEMA).write.mode("ignore").parquet(self._published)

    def _taken(self) -> DataFrame:
        return self.spark.read.schema(StructType.fromDDL(TAKEN_SCHEMA)).parquet(self._log)

    def taken(self, name: str) -> DataFrame:
        return self._taken().filter(F.col("dataset") == name)

    def waiting(self) -> DataFrame:
        """``run_id`` of the runs that took files, but broke off, or met the gate, before their tables were published."""
        done = self.spark.read.schema(StructType.fromDDL(PUBLISHED_SCHEMA)).parquet(self._published)
        return self._taken().select("run_id").distinct().join(done, "run_id", "left_anti")

    def mark_published(self, runs: DataFrame) -> None:
        runs.write.mode("append").parquet(self._published)

    def new_files(self, spec: Dataset, path: str) -> DataFrame:
        """The listed files that are not taken. A taken file that has changed is refused, since its rows cannot be withdrawn."""
        listed = lineage_cut(list_files(self.spark, path))
        before = self.taken(spec.name).select("file", F.struct("length", "modified").alias("_before"))
        compared = lineage_cut(listed.join(before, "file", "left"))
        changed = compared.filter("_before IS NOT NULL AND _before != struct(length, modified)").select("file").first()
        if changed is not None:
            raise ChangedFileError(f"{spec.name}: {changed['file']} has changed since it was taken")
        return compared.filter("_before IS NULL").drop("_before")

    def _schema(self, spec: Dataset, *extra: str) -> StructType:
        fields = [few_rows(self.spark, [], f"{c.raw} string").select(c.column()).schema.fields[0] for c in spec.columns]
        return StructType([*fields, *(StructField(e, StringType()) for e in (MALFORMED, *extra))])

    def _read(self, folder: str, schema: StructType) -> DataFrame:
        few = few_rows(self.spark, [], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields))
        few.write.mode("ignore").partitionBy(schema.fields[-1].name).parquet(folder)
        return self.spark.read.schema(schema).parquet(folder)

    def keyed_rows(self, spec: Dataset) -> DataFrame:
        return self._read(f"{self.base}/{spec.name}/keyed", self._schema(spec, PERIOD))

    def keyless_rows(self, spec: Dataset) -> DataFrame:
        return self._read(f"{self.base}/{spec.name}/keyless", self._schema(spec, FILE_KEY))

    def rows(self, spec: Dataset) -> DataFrame:
        """One row per key, and every row without one, of all files taken so far."""
        return self.keyed_rows(spec).drop(PERIOD).unionByName(self.keyless_rows(spec).drop(FILE_KEY))

    def _replace(self, rows: DataFrame, folder: str) -> None:
        """Rewrite the folders that ``rows`` have rows for, each in as many files as its size asks for."""
        level = rows.columns[-1]
        writer = rows.hint("rebalance", level).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(level).parquet(folder)

    def take(self, spec: Dataset, path: str, run_id: str, multi_line: bool = False) -> int:
        """Read the new files into the kept rows; the number of files that were new."""
        files = lineage_cut(self.new_files(spec, path))
        # names of this run's new files only, as any reader lists them
        paths = [_literal(row["path"]) for row in files.select("path").collect()]
        if not paths:
            return 0
        raw = lineage_cut(with_lineage(read_raw(self.spark, paths, spec.raw_columns, multi_line)))
        by_file = raw.withColumn(FILE_KEY, F.sha2(SOURCE_FILE, 256))
        self._replace(by_file, f"{self.base}/{spec.name}/raw")
        rows = typed(spec, by_file).columns
        known = lineage_cut(by_file.select(*(c.column() for c in spec.columns), MALFORMED, FILE_KEY))
        self._replace(known.filter(~_keyed(spec)).select(*rows, FILE_KEY), f"{self.base}/{spec.name}/keyless")
        self._merge(spec, known.filter(_keyed(spec)).select(*rows))
        counted = raw.groupBy(F.col(SOURCE_FILE).alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        entries = files.join(counted, "file", "left").select(
            F.lit(spec.name).alias("dataset"),
            "file",
            "length",
            "modified",
            F.coalesce("rows", F.lit(0)).alias("rows"),
            F.lit(run_id).alias("run_id"),
        )
        entries.write.mode("append").parquet(self._log)
        return len(paths)

    def _merge(self, spec: Dataset, arrived: DataFrame) -> None:
        """Set the arrived rows against the kept ones of the same keys; months without such a key are not read."""
        kept, key = self.keyed_rows(spec), list(spec.key)
        fresh = lineage_cut(dedupe(arrived, spec.key, spec.order))
        filed = kept.select(*key, F.col(PERIOD).alias("_filed")).join(fresh.select(*key), key, "left_semi")
        month = F.date_format(F.col(spec.day), "yyyy-MM") if spec.day else F.lit(None).cast("string")
        period = F.coalesce("_filed", month, F.lit(NO_PERIOD)).alias(PERIOD)
        placed = lineage_cut(fresh.join(filed, key, "left").select(*fresh.columns, period))
        # at most as many as the months of the calendar
        periods = [row[PERIOD] for row in placed.select(PERIOD).distinct().collect()]
        beside = kept.filter(F.col(PERIOD).isin(periods)).select(*placed.columns)
        merged = lineage_cut(dedupe(beside.unionByName(placed), spec.key, spec.order))
        self._replace(merged.select(*placed.columns), f"{self.base}/{spec.name}/keyed")


def run_incremental(
    spark: SparkSession,
    layers: Layers,
    kept: KeptRows,
    raw: str,
    specs: Sequence[Dataset] = (POLICIES, CLAIMS),
    limit: float = MAX_QUARANTINE_RATE,
    multi_line: bool = False,
) -> tuple[Outcome, Mapping[str, int]]:
    """The chain of ``run_medallion`` over the files in ``raw`` that no earlier run has taken.

    Raw files are read once and their rows deduplicated with the kept ones of the same keys only. The rules then run over all
    kept rows, because a new row can make rows of other datasets valid or invalid; that takes no sort and no shuffle of rows
    but the one to their references. Ledger, report, gate, silver, quarantine and gold are those of a run over all files.

    Returns the outcome and, by dataset, how many files were read. Without a new file nothing is published again, unless an
    earlier run took files and did not come to publishing.
    """
    outcome = Outcome(uuid.uuid4().hex)
    read = {s.name: kept.take(s, f"{raw.rstrip('/')}/{s.name}.csv", outcome.run_id, multi_line) for s in specs}
    runs = lineage_cut(kept.waiting())
    if runs.isEmpty():
        return outcome, read
    for spec in specs:
        known = {r.dataset: layers.staged(outcome.staged[r.dataset], GOOD) for r in spec.references}
        rows = kept.rows(spec)
        rules = rules_of(spec, rows)
        observed, counts = observe_ledger(judge(spec, rows, known), rules)
        outcome.staged[spec.name] = layers.stage(observed, spec.name, outcome.run_id)
        ledger = Ledger.from_counts(spec.name, counts.get, rules)
        raw_rows = kept.taken(spec.name).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if raw_rows < ledger.total_rows:
            raise RowsLostError(spec.name, raw_rows, ledger)
        outcome.ledgers[spec.name] = replace(ledger, duplicates_removed=raw_rows - ledger.total_rows)
    save_report(layers, outcome, spark)
    publish_silver(layers, outcome, specs, limit)
    build_gold(layers, outcome.run_id)
    kept.mark_published(runs)
    return outcome, read
