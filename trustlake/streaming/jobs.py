"""The batch operators on streams."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from trustlake.operators.bounded import few_rows
from trustlake.operators.dedupe import dedupe
from trustlake.operators.rules import FAILED, REPORT_SCHEMA, Ledger, Rule, apply_rules, gate, ledger_columns
from trustlake.operators.scoring import Scorer, check_requests, score_checked
from trustlake.session import lineage_cut
from trustlake.sources.storage import BAD, GOOD, OUTCOME, outcome

QUERY, BATCH, DAY = "query_id", "batch_id", "event_day"
NO_DAY = "unknown"
SCORES, REJECTED = "scores", "rejected"
#: Rows of a day that one task of the quality stream writes.
FILE_ROWS = 250_000


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when its checkpoint was made; a new checkpoint is a new query."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _folder(batch: DataFrame, checkpoint: str, batch_id: int) -> str:
    """Where a micro-batch goes: a repeated batch overwrites itself, and no other query's."""
    return f"{QUERY}={_query_id(batch.sparkSession, checkpoint)}/{BATCH}={batch_id}"


def stream_score(
    requests: DataFrame, scorer: Scorer, target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Score records as they arrive; refused ones are kept with their reasons.

    Stateless. Each micro-batch goes to folders of its own, so a repeated batch overwrites itself.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        folder = _folder(batch, checkpoint, batch_id)
        checked = check_requests(batch, scorer).persist()  # read and checked once for both sinks
        try:
            scored, rejected = score_checked(checked, scorer)
            for frame, name in ((scored, SCORES), (rejected, REJECTED)):
                frame.write.mode("overwrite").parquet(f"{target}/{name}/{folder}")
        finally:
            checked.unpersist()

    writer = requests.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_scored(spark: SparkSession, target: str) -> tuple[DataFrame, DataFrame]:
    """(scores, refused records) of everything ``stream_score`` has written so far."""
    return tuple(spark.read.parquet(f"{target}/{name}").drop(QUERY, BATCH) for name in (SCORES, REJECTED))


def stream_quality(
    events: DataFrame,
    rules: Sequence[Rule],
    key: Sequence[str],
    event_time: str,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    report: str | None = None,
    dataset: str = "events",
    limit: float | None = None,
) -> StreamingQuery:
    """Deduplicate, check and split a stream.

    A micro-batch is deduplicated in itself and against the stored rows of the same event days, whichever query stored
    them and however late it comes; copies of an event carry the same event time. Events without a time have a day of
    their own.

    Every micro-batch is written once, under its query and its own id, split by event day and outcome; a repeated batch
    overwrites itself, which makes the at-least-once callback an exactly-once table. One query at a time writes to a
    target.

    ``report`` is a folder that receives the ledger of each micro-batch before its rows are written; ``read_report`` adds
    them up. With ``limit`` a micro-batch of which a larger share breaks rules fails the query: its ledger stays, its rows
    are not written, and the query starts with it again.
    """
    if limit is not None and report is None:
        raise ValueError("a limit needs a folder for the report")
    typed = events.withColumn(event_time, F.col(event_time).cast("timestamp"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        day = F.coalesce(F.to_date(event_time).cast("string"), F.lit(NO_DAY))
        query_id = _query_id(batch.sparkSession, checkpoint)
        arrived = batch.withColumn(DAY, day).persist()  # its days are asked for apart from its rows
        split = None
        try:
            # copies have the same time, so the day is no part of the key
            rows = dedupe(arrived, key)
            stored = _stored_keys(arrived, key, target, query_id, batch_id)
            if stored is not None:
                rows = rows.join(stored, [*key, DAY], "left_anti")
            split = apply_rules(rows, rules).withColumn(OUTCOME, outcome())
            folder = _folder(batch, checkpoint, batch_id)
            if report is not None:
                split = split.persist()  # counted before it is written
                ledger = _batch_ledger(split, arrived.count(), rules, dataset)
                entries = few_rows(batch.sparkSession, ledger.rows(folder), REPORT_SCHEMA)
                entries.write.mode("overwrite").parquet(f"{report}/{folder}")
                if limit is not None:
                    gate(ledger, limit)
            by_day = _dealt_by_day(split, [*key, event_time])
            by_day.write.mode("overwrite").partitionBy(DAY, OUTCOME).parquet(f"{target}/{folder}")
        finally:
            if split is not None:
                split.unpersist()
            arrived.unpersist()

    writer = typed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _dealt_by_day(split: DataFrame, spread: Sequence[str]) -> DataFrame:
    """Rows dealt by day, large days in parts of about ``FILE_ROWS`` rows: else every task writes a file for every day, and
    every later micro-batch reads them all."""
    parts = F.ceil(F.count(F.lit(1)) / F.lit(FILE_ROWS)).alias("_parts")
    days = lineage_cut(split.groupBy(DAY).agg(parts))  # stored, so that the join knows how small they are
    return split.join(days, DAY).repartition(DAY, F.pmod(F.xxhash64(*spread), F.col("_parts"))).drop("_parts").select(*split.columns)


def _batch_ledger(split: DataFrame, arrived: int, rules: Sequence[Rule], dataset: str) -> Ledger:
    """Counts of a micro-batch; events that it repeats, or that are stored already, count as removed."""
    ledger = Ledger.from_counts(dataset, split.agg(*ledger_columns(rules)).first().asDict(), rules)
    return replace(ledger, duplicates_removed=arrived - ledger.total_rows)


def read_report(spark: SparkSession, report: str) -> DataFrame:
    """By dataset and rule, the sums of the ledgers of all micro-batches: the report of one batch over the same events."""
    counts = ("failed_rows", "total_rows", "valid_rows", "quarantined_rows", "duplicates_removed")
    ledgers = spark.read.schema(StructType.fromDDL(REPORT_SCHEMA)).parquet(report)
    rate = F.round(F.try_divide(F.col("quarantined_rows"), F.col("total_rows")), 4)
    return (
        ledgers.groupBy("dataset", "rule")
        .agg(*(F.sum(c).alias(c) for c in counts))
        .withColumn("quarantine_rate", F.coalesce(rate, F.lit(0.0)))
    )


def _stored_keys(rows: DataFrame, key: Sequence[str], target: str, query_id: str, batch_id: int) -> DataFrame | None:
    """Keys and days that other batches have stored for exactly the days of this one, or None if nothing is stored."""
    spark = rows.sparkSession
    places = [StructField(QUERY, StringType()), StructField(BATCH, LongType()), StructField(DAY, StringType())]
    try:
        stored = spark.read.schema(StructType([*(rows.schema[k] for k in key), *places])).parquet(target)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # a later attempt at this batch must not meet its own rows
    others = stored.filter((F.col(QUERY) != query_id) | (F.col(BATCH) != batch_id))
    return others.join(rows.select(DAY).distinct(), DAY, "left_semi").select(*key, DAY)


def read_checked(spark: SparkSession, target: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with reasons) of everything ``stream_quality`` has written so far."""
    everything = spark.read.parquet(target)
    good = everything.filter(F.col(OUTCOME) == GOOD).drop(OUTCOME, QUERY, BATCH, DAY, FAILED)
    bad = everything.filter(F.col(OUTCOME) == BAD).drop(OUTCOME, QUERY, BATCH, DAY)
    return good, bad
