"""Files, tables, versions, the medallion run, injected defects and the quality stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.functions.hashing import chosen
from trustlake.operators.defects import Defect, claim_defects, inject, inject_duplicates
from trustlake.operators.bounded import few_rows
from trustlake.operators.dedupe import COPIES
from trustlake.operators.relate import mark_existing
from trustlake.operators.rules import (
    FAILED,
    REPORT_SCHEMA,
    Ledger,
    QualityGateError,
    Rule,
    gate,
    ledger_columns,
    observe_ledger,
)
from trustlake.plans.datasets import CLAIMS, POLICIES
from trustlake.plans.incremental import KeptRows, run_incremental
from trustlake.plans.medallion import check_all, run_medallion
from trustlake.queries.bindings import (
    CHECKED_CLAIMS,
    CHECKED_POLICIES,
    FEATURE_ROWS,
    broken_sql,
    checked_claims,
    half_up,
    hit_sql,
    raw_claims,
    raw_policies,
    table,
    with_text_dates,
)
from trustlake.queries.catalogue import query
from trustlake.queries.quality import CLAIM_SELECT, LINE_RULES, LINES, MONTHLY_SQL, POLICY_SELECT, checked_lines, reasons
from trustlake.session import work_dir
from trustlake.sources.raw import MALFORMED, SOURCE_FILE, read_raw, with_lineage, write_raw
from trustlake.sources.storage import Snapshots, Storage, create_namespace, list_tables
from trustlake.streaming.jobs import read_checked, read_report, stream_quality

LOOSE_LIMIT = 0.35

# --- files and tables --------------------------------------------------------------------------------------------


def exported_customers(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "customers")
    write_raw(table(spark, sf_dir, "customer"), path)
    return path


@query(
    "s1_csv_roundtrip",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
)
def s1_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns lie differently in the second set of files."""
    customers, path = table(spark, sf_dir, "customer"), work_dir(spark, "customers")
    parts = customers.filter("c_custkey % 2 = 0"), customers.filter("c_custkey % 2 = 1").select(*reversed(customers.columns))
    for number, part in enumerate(parts):
        write_raw(part, f"{path}/{number}")
    return read_raw(spark, f"{path}/*", customers.columns).drop(MALFORMED, SOURCE_FILE)


@query(
    "s1_multiline",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || chr(10) || '"' || c_mktsegment || '",' || chr(10) AS c_note,
      CAST(NULL AS VARCHAR) AS _malformed FROM customer""",
)
def s1_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with quotes and line breaks, read from files that are split wherever a split ends."""
    path = work_dir(spark, "notes")
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('",\n'))
    customers = table(spark, sf_dir, "customer").select("c_custkey", note.alias("c_note"))
    write_raw(customers, path)
    return read_raw(spark, path, ["c_note", "c_custkey"], multi_line=True).drop(SOURCE_FILE)


@query("s2_lineage", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, true AS has_time, true AS has_file FROM customer")
def s2_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = exported_customers(spark, sf_dir)
    rows = with_lineage(read_raw(spark, path, table(spark, sf_dir, "customer").columns))
    return rows.select(
        "c_custkey",
        F.col("_ingested_at").isNotNull().alias("has_time"),
        F.col("_source_file").contains(path).alias("has_file"),
    )


@query("s3_write_read", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def s3_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    storage = Storage("path", work_dir(spark, "lake"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    storage.write(orders, "silver", "orders")
    storage.write(orders.filter("o_orderstatus <> 'P'").drop("o_orderstatus"), "silver", "orders")
    return storage.read(spark, "silver", "orders")


def new_namespace(spark: SparkSession) -> str:
    name = f"spark_catalog.lake_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, name, work_dir(spark, "warehouse"), "tables of one query")
    return name


@query("s4_table_mode", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def s4_table_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    storage = Storage("table", new_namespace(spark))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    storage.write(orders, "silver", "orders")
    storage.write(orders.filter("o_orderstatus <> 'P'").drop("o_orderstatus"), "silver", "orders")
    return storage.read(spark, "silver", "orders")


@query(
    "s12_catalog",
    "SELECT 'bronze_customer' AS table_name, count(*) AS n FROM customer "
    "UNION ALL SELECT 'bronze_orders', count(*) FROM orders",
)
def s12_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = new_namespace(spark)
    storage = Storage("table", namespace)
    counts = None
    for name in ("customer", "orders"):
        storage.write(table(spark, sf_dir, name), "bronze", name)
        stored = storage.read(spark, "bronze", name)
        line = stored.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"bronze_{name}").alias("table_name"), "n")
        counts = line if counts is None else counts.unionByName(line)
    listed = list_tables(spark, namespace).select(F.col("tableName").alias("table_name"))
    return listed.join(counts, "table_name")


@query(
    "s13_versions",
    """SELECT 'current' AS version, count(*) AS n, 2 AS versions FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'first', count(*), 2 FROM orders""",
)
def s13_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row count now and in the first version, next to the length of the history."""
    lake = Snapshots(spark, work_dir(spark, "lake"))
    orders = table(spark, sf_dir, "orders")
    lake.write(orders, "silver", "orders")
    lake.write(orders.filter("o_orderstatus <> 'P'"), "silver", "orders")
    versions = lake.history("silver", "orders").count()

    def line(name: str, frame: DataFrame) -> DataFrame:
        counted = frame.agg(F.count(F.lit(1)).alias("n"))
        return counted.select(F.lit(name).alias("version"), "n", F.lit(versions).alias("versions"))

    return line("current", lake.read("silver", "orders")).unionByName(line("first", lake.read("silver", "orders", 0)))


@query(
    "s9_quality_report",
    f"""WITH {LINES}, totals AS (
      SELECT count(*) AS n, count(*) FILTER (WHERE failed_rules <> '') AS bad, CAST(sum(copies - 1) AS BIGINT) AS dup
      FROM lines_checked)
    """
    + " UNION ALL ".join(
        f"""SELECT 'lines' AS dataset, '{r.name}' AS rule, (SELECT count(*) FROM lines_checked WHERE
        list_contains(string_split(failed_rules, ','), '{r.name}')) AS failed_rows, n AS total_rows, n - bad AS valid_rows,
        bad AS quarantined_rows, {half_up("bad", "n", 4)} AS quarantine_rate, dup AS duplicates_removed FROM totals"""
        for r in LINE_RULES
    ),
)
def s9_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while the checked rows are being written; stored; read back."""
    lake = Snapshots(spark, work_dir(spark, "lake"))
    observed, counts = observe_ledger(checked_lines(spark, sf_dir), LINE_RULES, COPIES)
    lake.stage(observed.drop(COPIES), "lines")
    ledger = Ledger.from_counts("lines", counts.get, LINE_RULES)
    lake.append(few_rows(spark, ledger.rows("run"), REPORT_SCHEMA), "reports", "quality")
    return lake.read_appended("reports", "quality").drop("run_id")


# --- the medallion run -------------------------------------------------------------------------------------------


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"policies": raw_policies(spark, sf_dir), "claims": raw_claims(spark, sf_dir)}


def export_feeds(spark: SparkSession, sf_dir: str, raw: str, parts: tuple[int, ...]) -> None:
    """Raw files whose columns lie differently from part to part; those of part 2 are rows that are cut off."""
    for name, frame in raw_feeds(spark, sf_dir).items():
        for number, part in enumerate((frame, frame.select(*reversed(frame.columns)))):
            if number in parts:
                write_raw(part.filter(F.pmod(F.xxhash64(frame.columns[0]), F.lit(2)) == number), f"{raw}/{name}.csv/part={number}")
        if 2 in parts:
            cut_off = frame.select(F.concat_ws(",", *frame.columns[:2]).alias("line"))
            cut_off.filter(chosen("cut", 0.01, frame.columns[0])).write.text(f"{raw}/{name}.csv/part=2")


@query("g1_medallion", MONTHLY_SQL)
def g1_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw files, whose columns lie differently from file to file and some of whose rows are cut off, to bronze, silver,
    quarantine and gold, all stored; the monthly report read back."""
    raw = work_dir(spark, "raw")
    export_feeds(spark, sf_dir, raw, (0, 1, 2))
    lake = Snapshots(spark, work_dir(spark, "lake"))
    run_medallion(spark, lake, raw, limit=LOOSE_LIMIT)
    return with_text_dates(lake.read("gold", "claims_monthly"))


@query("g1_incremental", MONTHLY_SQL)
def g1_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report after two runs, the second of which reads only the files that have come in between."""
    raw, lake = work_dir(spark, "raw"), Snapshots(spark, work_dir(spark, "lake"))
    kept = KeptRows(spark, work_dir(spark, "kept"))
    for parts in ((0, 2), (1,)):
        export_feeds(spark, sf_dir, raw, parts)
        run_incremental(spark, lake, kept, raw, limit=1.0)
    return with_text_dates(lake.read("gold", "claims_monthly"))


@query("s7_gold_handover", f"WITH {FEATURE_ROWS} SELECT * FROM features")
def s7_gold_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What training reads: the feature table as the run has stored it."""
    lake = Snapshots(spark, work_dir(spark, "lake"))
    run_medallion(spark, lake, raw_feeds(spark, sf_dir), limit=LOOSE_LIMIT)
    return lake.read("gold", "fraud_features")


LEFTOVERS = {
    "no amount": "claim_amount IS NULL",
    "amount not positive": "claim_amount <= 0",
    "reported early": "report_date < incident_date",
    "policy not in silver": "policy_id NOT IN (SELECT policy_id FROM policies)",
}


@query(
    "p15_leftovers",
    f"WITH {CHECKED_CLAIMS} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS leftover, count(*) FILTER (WHERE {broken}) AS n, count(*) AS claims FROM claims"
        for name, broken in LEFTOVERS.items()
    ),
)
def p15_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing that a rule refuses is left in silver."""
    lake = published(spark, sf_dir)
    claims = mark_existing(lake.read("silver", "claims"), lake.read("silver", "policies"), "policy_id", "known")
    conditions = {**LEFTOVERS, "policy not in silver": "NOT known"}
    counts = claims.agg(
        F.count(F.lit(1)).alias("claims"), *(F.count_if(F.expr(c)).alias(name) for name, c in conditions.items())
    )
    lines = [F.struct(F.lit(name).alias("leftover"), F.col(f"`{name}`").alias("n")) for name in conditions]
    return counts.select(F.inline(F.array(*lines)), "claims")


@query(
    "g2_gate",
    f"""WITH {CHECKED_CLAIMS}, n AS (SELECT count(*) FILTER (WHERE failed_rules <> '') AS bad, count(*) AS total
      FROM claims_checked), c AS (SELECT bad, total, {half_up("bad", "total", 4)} AS rate FROM n)
    SELECT 'strict' AS gate, rate AS quarantine_rate, 100 * bad <= 5 * total AS passed FROM c
    UNION ALL SELECT 'loose', rate, 100 * bad <= {round(100 * LOOSE_LIMIT)} * total FROM c""",
)
def g2_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = checked_claims(spark, sf_dir).agg(*ledger_columns(CLAIMS.rules, COPIES)).first().asDict()
    ledger = Ledger.from_counts("claims", counts, CLAIMS.rules)
    lines = []
    for name, limit in (("strict", 0.05), ("loose", LOOSE_LIMIT)):
        try:
            gate(ledger, limit)
            passed = True
        except QualityGateError:
            passed = False
        lines.append((name, ledger.quarantine_rate, passed))
    return few_rows(spark, lines, "gate string, quarantine_rate double, passed boolean")


@query(
    "g4_rerun",
    f"""WITH {CHECKED_CLAIMS}, c AS (SELECT count(*) AS n FROM claims)
    SELECT v AS version, n FROM c, (VALUES (0), (1)) versions(v)""",
)
def g4_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running twice makes a second version with the same rows."""
    lake = Snapshots(spark, work_dir(spark, "lake"))
    for run in ("one", "two"):
        for spec, frame in ((POLICIES, raw_policies(spark, sf_dir)), (CLAIMS, raw_claims(spark, sf_dir))):
            lake.write(frame, "bronze", spec.name)
        for handle in check_all(lake, (POLICIES, CLAIMS), run).staged.values():
            lake.publish(handle, run)

    def line(version: int) -> DataFrame:
        counted = lake.read("silver", "claims", version).agg(F.count(F.lit(1)).alias("n"))
        return counted.select(F.lit(version).alias("version"), "n")

    return line(0).unionByName(line(1))


def published(spark: SparkSession, sf_dir: str) -> Snapshots:
    lake = Snapshots(spark, work_dir(spark, "lake"))
    for spec, frame in ((POLICIES, raw_policies(spark, sf_dir)), (CLAIMS, raw_claims(spark, sf_dir))):
        lake.write(frame, "bronze", spec.name)
    for handle in check_all(lake, (POLICIES, CLAIMS), "run").staged.values():
        lake.publish(handle)
    return lake


@query("g5_silver_dim", f"WITH {CHECKED_POLICIES} SELECT {POLICY_SELECT} FROM policies")
def g5_silver_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_dates(published(spark, sf_dir).read("silver", "policies"))


@query(
    "g5_silver_fact",
    f"""WITH {CHECKED_CLAIMS} SELECT {CLAIM_SELECT}, failed_rules, failed_rules = '' AS published FROM claims_checked""",
)
def g5_silver_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and quarantine together, as stored."""
    lake = published(spark, sf_dir)
    good = lake.read("silver", "claims").withColumns({"failed_rules": F.lit(""), "published": F.lit(True)})
    bad = lake.read("quarantine", "claims").withColumns({"failed_rules": reasons(), "published": F.lit(False)})
    return with_text_dates(good.unionByName(bad.drop(FAILED)))


# --- defects -----------------------------------------------------------------------------------------------------


def tidy_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as typed, faultless claims."""
    day_of = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("claim_id"),
        F.concat(F.lit("POL"), F.col("o_custkey")).alias("policy_id"),
        day_of.alias("incident_date"),
        F.date_add(day_of, 3).alias("report_date"),
        F.col("o_totalprice").alias("claim_amount"),
        F.lower("o_orderpriority").alias("channel"),
    )


AMOUNT_SQL = f"CASE WHEN {hit_sql('42|d1', 0.01, 'o_orderkey')} THEN NULL ELSE o_totalprice END"
INJECTED_COLUMNS = f"""o_orderkey AS claim_id,
  CASE WHEN {hit_sql("42|d5", 0.005, "o_orderkey")} THEN 'POL999999' ELSE 'POL' || o_custkey END AS policy_id,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS incident_date,
  CAST(CAST(o_orderdate AS DATE) + CASE WHEN {hit_sql("42|d4", 0.005, "o_orderkey")} THEN -10 ELSE 3 END AS VARCHAR)
    AS report_date,
  CASE WHEN {hit_sql("42|d3", 0.005, "o_orderkey")} THEN -abs({AMOUNT_SQL}) ELSE {AMOUNT_SQL} END AS claim_amount,
  CASE WHEN {hit_sql("42|d2", 0.01, "o_orderkey")} THEN NULL ELSE lower(o_orderpriority) END AS channel"""


@query("d1_inject", f"SELECT {INJECTED_COLUMNS} FROM orders")
def d1_inject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_dates(inject(tidy_claims(spark, sf_dir), claim_defects(), "claim_id"))


@query(
    "d6_duplicates",
    f"""SELECT o_orderkey AS claim_id, 1 AS n FROM orders
    UNION ALL SELECT o_orderkey, 1 FROM orders WHERE {hit_sql("42|d6", 0.01, "o_orderkey")}""",
)
def d6_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject_duplicates(tidy_claims(spark, sf_dir), "claim_id").select("claim_id", F.lit(1).alias("n"))


# --- the quality stream ------------------------------------------------------------------------------------------

EVENT_RULES = (
    Rule("value_present", "value IS NOT NULL"),
    Rule("value_positive", "value IS NULL OR value > 0"),
    Rule("type_present", "event_type IS NOT NULL"),
)
EVENT_FAILED = broken_sql(
    ("value_present", "value IS NULL"), ("value_positive", "value <= 0"), ("type_present", "event_type IS NULL")
)
EVENTS_SQL = f"""SELECT event_id, user_id, value, event_type, {EVENT_FAILED} AS failed_rules FROM (
  SELECT event_id, user_id,
         CASE WHEN {hit_sql("42|negative", 0.01, "event_id")} THEN -v ELSE v END AS value,
         CASE WHEN {hit_sql("42|untyped", 0.01, "event_id")} THEN NULL ELSE event_type END AS event_type
  FROM (SELECT *, CASE WHEN {hit_sql("42|empty", 0.01, "event_id")} THEN NULL ELSE value END AS v FROM events))"""


def event_defects() -> tuple[Defect, ...]:
    return (
        Defect("empty", "value", F.lit(None), 0.01),
        Defect("negative", "value", -F.col("value"), 0.01),
        Defect("untyped", "event_type", F.lit(None), 0.01),
    )


@query("r2_stream_quality", EVENTS_SQL)
def r2_stream_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in many files, one per micro-batch, with defects and with copies in other files; a second query with a
    new checkpoint then reads half of the files again. Each event is kept once and sorted into good or bad."""
    events = inject(table(spark, sf_dir, "events"), event_defects(), "event_id")
    arriving, again, target = work_dir(spark, "events"), work_dir(spark, "events"), work_dir(spark, "checked")
    half = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    events.unionByName(events.filter(chosen("copy", 0.05, "event_id"))).repartition(6).write.parquet(arriving)
    events.filter(half).repartition(2).write.parquet(again)
    for path in (arriving, again):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
        stream_quality(stream, EVENT_RULES, ["event_id"], "ts", target, work_dir(spark, "offsets")).awaitTermination()
    good, bad = read_checked(spark, target)
    columns = ("event_id", "user_id", "value", "event_type")
    return good.select(*columns, F.lit("").alias("failed_rules")).unionByName(bad.select(*columns, reasons()))


@query(
    "g2_stream_ledger",
    f"""WITH checked AS ({EVENTS_SQL}),
    totals AS (SELECT count(*) AS n, count(*) FILTER (WHERE failed_rules <> '') AS bad FROM checked),
    copies AS (SELECT count(*) AS c FROM events WHERE {hit_sql("copy", 0.05, "event_id")}),
    counted AS ({" UNION ALL ".join(
        f"SELECT '{r.name}' AS rule, count(*) FILTER (WHERE list_contains(string_split(failed_rules, ','), '{r.name}')) "
        "AS failed_rows FROM checked" for r in EVENT_RULES)})
    SELECT 'events' AS dataset, rule, failed_rows, n AS total_rows, n - bad AS valid_rows, bad AS quarantined_rows,
      c AS duplicates_removed, {half_up("bad", "n", 4)} AS quarantine_rate FROM counted, totals, copies""",
)
def g2_stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a gated stream, summed over its micro-batches, is that of one batch."""
    events = inject(table(spark, sf_dir, "events"), event_defects(), "event_id")
    arriving, report = work_dir(spark, "events"), work_dir(spark, "ledgers")
    events.unionByName(events.filter(chosen("copy", 0.05, "event_id"))).repartition(4).write.parquet(arriving)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    stream_quality(
        stream, EVENT_RULES, ["event_id"], "ts", work_dir(spark, "checked"), work_dir(spark, "offsets"),
        report=report, limit=LOOSE_LIMIT,
    ).awaitTermination()
    return read_report(spark, report)
