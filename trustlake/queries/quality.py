"""Cleaning, rules, joins, aggregates and features on the claim feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.functions.cleaning import as_double, folded, safe_cast
from trustlake.functions.hashing import chosen
from trustlake.functions.measures import days_between
from trustlake.operators import gold
from trustlake.operators.dedupe import COPIES, dedupe
from trustlake.operators.defects import inject_duplicates
from trustlake.operators.digest_tree import reconcile_by_digest
from trustlake.operators.kept_rollup import KeptMonthly, applied, superseding
from trustlake.operators.relate import conservation, joined_by_key, mark_existing, orphans, reconcile
from trustlake.operators.rules import (
    CLAIM_RULES,
    FAILED,
    KEY_PRESENT,
    Rule,
    apply_rules,
    failures_by_rule,
    ledger_frame,
    quarantine_reasons,
    request_rules,
    split_valid,
)
from trustlake.operators.scoring import normalise_requests
from trustlake.operators.selection import group_quantile
from trustlake.operators.sketches import daily_sketches, over_days, sketched_distinct, sketched_quantiles
from trustlake.plans.datasets import CLAIMS, POLICIES, check
from trustlake.queries.bindings import (
    CHECKED_CLAIMS,
    CHECKED_POLICIES,
    CLEAN_CLAIMS,
    CLEAN_POLICIES,
    FEATURE_ROWS,
    RAW_CLAIMS,
    RAW_POLICIES,
    RECORDS,
    broken_sql,
    checked_claims,
    clean_claims,
    clean_policies,
    half_up,
    hit_sql,
    raw_claims,
    raw_policies,
    round_sql,
    silver,
    table,
    text_dates_sql,
    valid_policies,
    with_text_dates,
)
from trustlake.queries.catalogue import query
from trustlake.session import lineage_cut, work_dir

POLICY_COLUMNS = ("policy_id", "product", "region", "customer_age", "start_date", "end_date", "annual_premium")
POLICY_DATES = ("start_date", "end_date")
CLAIM_COLUMNS = (
    "policy_id",
    "claim_id",
    "incident_date",
    "report_date",
    "claim_amount",
    "channel",
    "description",
    "is_fraud",
)
CLAIM_DATES = ("incident_date", "report_date")
POLICY_SELECT = text_dates_sql(POLICY_COLUMNS, POLICY_DATES)
CLAIM_SELECT = text_dates_sql(CLAIM_COLUMNS, CLAIM_DATES)
ALL_CLAIM_RULES = (KEY_PRESENT, *CLAIM_RULES)


def reasons() -> F.Column:
    return F.array_join(FAILED, ",").alias("failed_rules")


# --- cleaning ----------------------------------------------------------------------------------------------------


@query(
    "p1_safe_cast",
    f"WITH {RAW_CLAIMS} SELECT trim(claim_id) AS claim_id, TRY_CAST(trim(claim_amount) AS DOUBLE) AS claim_amount, "
    "TRY_CAST(trim(policy_id) AS BIGINT) AS policy_number FROM raw_claims",
)
def p1_safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_claims(spark, sf_dir).select(
        F.trim("claim_id").alias("claim_id"),
        safe_cast("claim_amount", "double").alias("claim_amount"),
        safe_cast("policy_id", "bigint").alias("policy_number"),
    )


@query(
    "p2_normalise",
    f"WITH {RAW_POLICIES} SELECT trim(policy_id) AS policy_id, lower(trim(product)) AS product, "
    "trim(region) AS region FROM raw_policies",
)
def p2_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_policies(spark, sf_dir).select(
        F.trim("policy_id").alias("policy_id"), folded("product").alias("product"), F.trim("region").alias("region")
    )


@query(
    "p3_fill_default",
    f"WITH {RAW_CLAIMS} SELECT coalesce(lower(trim(channel)), 'unknown') AS channel, count(*) AS n "
    "FROM raw_claims GROUP BY 1",
)
def p3_fill_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = F.coalesce(folded("channel"), F.lit("unknown")).alias("channel")
    return raw_claims(spark, sf_dir).groupBy(filled).agg(F.count(F.lit(1)).alias("n"))


@query("p4_clean_dim", f"WITH {CLEAN_POLICIES} SELECT {POLICY_SELECT} FROM policies_all")
def p4_clean_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_dates(clean_policies(spark, sf_dir))


@query("p4_clean_fact", f"WITH {CLEAN_CLAIMS} SELECT {CLAIM_SELECT} FROM claims_copies")
def p4_clean_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_dates(clean_claims(spark, sf_dir))


# --- rules -------------------------------------------------------------------------------------------------------

LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_RULES = (
    Rule("shipped_after_order", "l_shipdate >= o_orderdate"),
    Rule("not_returned", "l_returnflag <> 'R'"),
    Rule("more_than_one", "l_quantity > 1"),
)


def checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, one per key, next to the date of their order."""
    lines = dedupe(table(spark, sf_dir, "lineitem"), LINE_KEY, ("l_shipdate", "l_extendedprice"), copies=COPIES)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return apply_rules(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left"), LINE_RULES)


LINE_FAILED = broken_sql(
    ("shipped_after_order", "o_orderdate IS NULL OR l_shipdate IS NULL OR l_shipdate < o_orderdate"),
    ("not_returned", "l_returnflag IS NULL OR l_returnflag = 'R'"),
    ("more_than_one", "l_quantity IS NULL OR l_quantity <= 1"),
)

# the kept copy is the largest by ship date, price and then every column in table order
LINES = f"""lines AS (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC,
    l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
    l_linestatus DESC) = 1),
lines_checked AS (SELECT lines.*, {LINE_FAILED} AS failed_rules
                  FROM lines LEFT JOIN orders ON l_orderkey = o_orderkey)"""


@query("p5_apply_rules", f"WITH {LINES} SELECT l_orderkey, l_linenumber, failed_rules FROM lines_checked")
def p5_apply_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_lines(spark, sf_dir).select(*LINE_KEY, reasons())


@query("p6_valid", f"WITH {CHECKED_CLAIMS} SELECT {CLAIM_SELECT} FROM claims")
def p6_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_dates(split_valid(checked_claims(spark, sf_dir))[0].drop(COPIES))


@query(
    "p6_quarantine",
    f"WITH {CHECKED_CLAIMS} SELECT {CLAIM_SELECT}, failed_rules FROM claims_checked WHERE failed_rules <> ''",
)
def p6_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_valid(checked_claims(spark, sf_dir))
    return with_text_dates(bad.drop(COPIES)).withColumn("failed_rules", reasons()).drop(FAILED)


def odd_number(value: str, key: str) -> F.Column:
    """A raw number of which some are no number, or infinite."""
    return (
        F.when(chosen("nan", 0.02, key), F.lit("NaN"))
        .when(chosen("infinite", 0.02, key), F.lit("Infinity"))
        .when(chosen("minus", 0.02, key), F.lit("-Infinity"))
        .otherwise(F.col(value))
    )


def odd_sql(value: str, key: str) -> str:
    """SQL of ``odd_number``."""
    return f"""CASE WHEN {hit_sql("nan", 0.02, key)} THEN 'NaN' WHEN {hit_sql("infinite", 0.02, key)} THEN 'Infinity'
      WHEN {hit_sql("minus", 0.02, key)} THEN '-Infinity' ELSE {value} END"""


ODD_POLICIES = CHECKED_POLICIES.replace(
    "TRY_CAST(trim(annual_premium) AS DOUBLE)", f"TRY_CAST({odd_sql('annual_premium', 'policy_id')} AS DOUBLE)"
)
ODD_CLAIMS = CHECKED_CLAIMS.replace(
    "TRY_CAST(trim(claim_amount) AS DOUBLE)", f"TRY_CAST({odd_sql('claim_amount', 'claim_id')} AS DOUBLE)"
)


@query("p7_dim_rules", f"WITH {ODD_POLICIES} SELECT policy_id, failed_rules FROM policies_checked")
def p7_dim_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_policies(spark, sf_dir).withColumn("annual_premium", odd_number("annual_premium", "policy_id"))
    return check(POLICIES, raw).select("policy_id", reasons())


@query("p8_fact_rules", f"WITH {ODD_CLAIMS} SELECT claim_id, failed_rules FROM claims_checked")
def p8_fact_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_claims(spark, sf_dir).withColumn("claim_amount", odd_number("claim_amount", "claim_id"))
    return check(CLAIMS, raw, {"policies": valid_policies(spark, sf_dir)}).select("claim_id", reasons())


BOUND_PRODUCTS = ("automobile", "building", "furniture", "machinery")
BOUND_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
BOUND_CHANNELS = ("1-urgent", "2-high", "3-medium", "5-low", "unknown")
BOUND_RULES = request_rules(BOUND_PRODUCTS, BOUND_REGIONS, BOUND_CHANNELS, with_text=True)


def requests(spark: SparkSession, sf_dir: str, feeds: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Every raw claim with its policy's raw columns, typed but unchecked, as scoring requests."""
    claims, policies = feeds or (clean_claims(spark, sf_dir), clean_policies(spark, sf_dir))
    return claims.join(policies, "policy_id").withColumnRenamed("start_date", "policy_start_date")


def one_of_sql(column: str, allowed: tuple[str, ...]) -> str:
    return f"{column} IS NULL OR {column} NOT IN ({', '.join(repr(v) for v in allowed)})"


REQUEST_FAILED = broken_sql(
    ("claim_id_present", "claim_id IS NULL OR claim_id = ''"),
    ("product_known", one_of_sql("product", BOUND_PRODUCTS)),
    ("region_known", one_of_sql("region", BOUND_REGIONS)),
    ("channel_known", one_of_sql("channel", BOUND_CHANNELS)),
    ("age_in_range", "customer_age IS NULL OR customer_age < 18 OR customer_age > 120"),
    ("claim_amount_positive", "claim_amount IS NULL OR claim_amount <= 0 OR isnan(claim_amount) OR isinf(claim_amount)"),
    ("premium_positive", "annual_premium IS NULL OR annual_premium <= 0 OR isnan(annual_premium) OR isinf(annual_premium)"),
    ("start_date_valid", "policy_start_date IS NULL"),
    ("incident_date_valid", "incident_date IS NULL"),
    ("reported_after_incident", "report_date IS NULL OR incident_date IS NULL OR report_date < incident_date"),
    ("description_length", "description IS NULL OR length(description) < 1 OR length(description) > 2000"),
)


@query(
    "p9_request_rules",
    f"""WITH {CLEAN_POLICIES}, {CLEAN_CLAIMS},
    requests AS (SELECT claims_copies.* EXCLUDE (claim_amount), product, region, customer_age, start_date AS policy_start_date,
                        annual_premium,
                        TRY_CAST({odd_sql("CAST(claim_amount AS VARCHAR)", "claim_id")} AS DOUBLE) AS claim_amount
                 FROM claims_copies JOIN policies_all ON claims_copies.policy_id = policies_all.policy_id)
    SELECT claim_id, {REQUEST_FAILED} AS failed_rules FROM requests""",
)
def p9_request_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = requests(spark, sf_dir).withColumn("claim_amount", safe_cast(odd_number("claim_amount", "claim_id"), "double"))
    return apply_rules(normalise_requests(odd), BOUND_RULES).select("claim_id", reasons())


# --- joins -------------------------------------------------------------------------------------------------------


@query(
    "j1_existence_flag",
    f"""WITH {CHECKED_POLICIES}, {CLEAN_CLAIMS}
    SELECT claim_id, policies.policy_id IS NOT NULL AS policy_found
    FROM claims_copies LEFT JOIN policies ON claims_copies.policy_id = policies.policy_id""",
)
def j1_existence_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_existing(clean_claims(spark, sf_dir), valid_policies(spark, sf_dir), "policy_id", "policy_found")
    return marked.select("claim_id", "policy_found")


@query(
    "j3_claim_records",
    f"WITH {RECORDS} SELECT {CLAIM_SELECT}, product, region, customer_age, "
    f"{text_dates_sql(POLICY_DATES, POLICY_DATES)}, annual_premium FROM records",
)
def j3_claim_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_dates(gold.claim_records(*silver(spark, sf_dir)))


def changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table with a few changed values and a few missing rows, drawn by the hash of the key."""
    price, late = chosen("price", 0.02, "o_orderkey"), chosen("status", 0.03, "o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .withColumn("o_totalprice", F.when(price, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
        .withColumn("o_orderpriority", F.when(late, F.lit(None)).otherwise(F.col("o_orderpriority")))
        .filter(~chosen("lost", 0.01, "o_orderkey"))
    )


RECONCILED = f"""WITH pairs AS (
    SELECT a.o_orderkey IS NOT NULL AND NOT {hit_sql("lost", 0.01, "a.o_orderkey")} AS in_both,
           {hit_sql("price", 0.02, "a.o_orderkey")} AS price_differs,
           {hit_sql("status", 0.03, "a.o_orderkey")} AND o_orderpriority IS NOT NULL AS priority_differs
    FROM orders a),
  counts AS (SELECT count(*) FILTER (WHERE in_both) AS compared, count(*) FILTER (WHERE NOT in_both) AS only_left,
             count(*) FILTER (WHERE in_both AND price_differs) AS price,
             count(*) FILTER (WHERE in_both AND priority_differs) AS priority,
             (SELECT count(*) FROM orders WHERE {hit_sql("42|d6", 0.01, "o_orderkey")}) AS copies FROM pairs)
  SELECT 'o_totalprice' AS "column", price AS mismatches, compared, only_left, CAST(0 AS BIGINT) AS only_right,
         copies AS copies_left, CAST(0 AS BIGINT) AS copies_right FROM counts
  UNION ALL SELECT 'o_orderpriority', priority, compared, only_left, 0, copies, 0 FROM counts
  UNION ALL SELECT 'o_custkey', 0, compared, only_left, 0, copies, 0 FROM counts"""


@query("j5_reconcile", RECONCILED)
def j5_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = inject_duplicates(table(spark, sf_dir, "orders"), "o_orderkey"), changed_orders(spark, sf_dir)
    return reconcile(left, right, ["o_orderkey"], ["o_totalprice", "o_orderpriority", "o_custkey"])


@query("j5_digest_tree", RECONCILED)
def j5_digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same comparison by digests; the changed table's keys are unique."""
    left, right = inject_duplicates(table(spark, sf_dir, "orders"), "o_orderkey"), changed_orders(spark, sf_dir)
    columns = ["o_totalprice", "o_orderpriority", "o_custkey"]
    return reconcile_by_digest(left, right, ["o_orderkey"], columns, unique=True)


@query(
    "j6_orphans",
    f"""WITH {CHECKED_POLICIES}, {CLEAN_CLAIMS} SELECT claim_id, policy_id FROM claims_all
    WHERE policy_id IS NULL OR policy_id NOT IN (SELECT policy_id FROM policies)""",
)
def j6_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = dedupe(clean_claims(spark, sf_dir), ["claim_id"])
    return orphans(claims, valid_policies(spark, sf_dir), "policy_id").select("claim_id", "policy_id")


# --- aggregates --------------------------------------------------------------------------------------------------

LINE_COLUMNS = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


@query(
    "a1_dedupe",
    f"WITH {LINES} SELECT {', '.join(LINE_COLUMNS)}, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, copies "
    "FROM lines",
)
def a1_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dedupe(table(spark, sf_dir, "lineitem"), LINE_KEY, ("l_shipdate", "l_extendedprice"), copies="copies")
    return lines.select(*LINE_COLUMNS, F.col("l_shipdate").cast("date").cast("string").alias("l_shipdate"), "copies")


MONTHLY_GROUPS = """
  SELECT CAST(date_trunc('month', incident_date) AS DATE) AS month, product, region, count(*) AS n,
         CAST(sum(CAST(claim_amount AS DECIMAL(18, 2))) * 100 AS HUGEINT) AS cents, sum(is_fraud) AS frauds
  FROM records GROUP BY 1, 2, 3"""
MONTHLY = f"""{RECORDS},
monthly_groups AS ({MONTHLY_GROUPS}),
monthly AS (SELECT month, product, region, n AS n_claims, CAST(cents AS DOUBLE) / 100.0 AS total_amount,
            {half_up("cents", "n * 100", 2)} AS avg_amount, {half_up("frauds", "n", 4)} AS fraud_rate
            FROM monthly_groups)"""
MONTHLY_SQL = f"""WITH {MONTHLY} SELECT CAST(month AS VARCHAR) AS month, product, region, n_claims, total_amount,
avg_amount, fraud_rate FROM monthly"""


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.claims_monthly(*silver(spark, sf_dir))


@query("a2_monthly", MONTHLY_SQL)
def a2_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_dates(monthly(spark, sf_dir))


@query("a2_kept_monthly", MONTHLY_SQL)
def a2_kept_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table from the states of three runs: older versions of rows come first and are superseded, some policies come
    after their claims."""
    claims, policies = silver(spark, sf_dir)
    old_claim, old_policy = chosen("old claim", 0.2, "claim_id"), chosen("old policy", 0.2, "policy_id")
    earlier_claims = claims.withColumns(
        {
            "incident_date": F.when(old_claim, F.add_months("incident_date", -1)).otherwise(F.col("incident_date")),
            "report_date": F.when(old_claim, F.date_sub("report_date", 1)).otherwise(F.col("report_date")),
            "claim_amount": F.when(old_claim, F.col("claim_amount") + 1000).otherwise(F.col("claim_amount")),
        }
    )
    earlier_policies = policies.withColumns(
        {
            "start_date": F.when(old_policy, F.date_sub("start_date", 1)).otherwise(F.col("start_date")),
            "region": F.when(old_policy, F.lit("unassigned")).otherwise(F.col("region")),
        }
    )
    late_claim, late_policy = chosen("late claim", 0.3, "claim_id"), chosen("late policy", 0.2, "policy_id")
    runs = (
        (earlier_claims.filter(~late_claim), earlier_policies.filter(~late_policy)),
        (claims.filter(late_claim | old_claim), policies.limit(0)),
        (claims.limit(0), policies.filter(late_policy | old_policy)),
    )
    kept = KeptMonthly(spark, work_dir(spark, "kept"))
    kept_claims, kept_policies = claims.limit(0), policies.limit(0)
    for number, (new_claims, new_policies) in enumerate(runs):
        claim_changes = lineage_cut(superseding(kept_claims, new_claims, ["claim_id"], ["report_date"]))
        policy_changes = lineage_cut(superseding(kept_policies, new_policies, ["policy_id"], ["start_date"]))
        kept.add(str(number), kept_claims, claim_changes, kept_policies, policy_changes)
        kept_claims = lineage_cut(applied(kept_claims, claim_changes, ["claim_id"]))
        kept_policies = lineage_cut(applied(kept_policies, policy_changes, ["policy_id"]))
    return with_text_dates(kept.monthly())


@query(
    "a3_failures_by_rule",
    f"WITH {LINES} "
    + " UNION ALL ".join(
        f"SELECT '{r.name}' AS rule, count(*) FILTER (WHERE list_contains(string_split(failed_rules, ','), '{r.name}')) "
        "AS failed_rows FROM lines_checked"
        for r in LINE_RULES
    ),
)
def a3_failures_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures_by_rule(checked_lines(spark, sf_dir), LINE_RULES)


@query(
    "a4_quality_totals",
    f"""WITH {LINES}, totals AS (SELECT count(*) AS n, count(*) FILTER (WHERE failed_rules <> '') AS bad FROM lines_checked)
    SELECT n AS total_rows, bad AS quarantined_rows, n - bad AS valid_rows, {half_up("bad", "n", 4)} AS quarantine_rate
    FROM totals""",
)
def a4_quality_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_frame(checked_lines(spark, sf_dir), LINE_RULES)


@query(
    "a5_duplicates_removed",
    """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS
    duplicates_removed FROM lineitem""",
)
def a5_duplicates_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_frame(checked_lines(spark, sf_dir), LINE_RULES, COPIES).select("duplicates_removed")


def segment_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the market segment of its customer."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.lower("c_mktsegment").alias("product"))
    orders = table(spark, sf_dir, "orders")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("claim_id"), "product", F.col("o_totalprice").alias("claim_amount"), "o_orderstatus"
    )


AMOUNTS = """amounts AS (SELECT o_orderkey AS claim_id, lower(c_mktsegment) AS product, o_totalprice AS claim_amount,
  o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey)"""
MEDIANS_SQL = f"WITH {AMOUNTS} SELECT product, round(median(claim_amount), 6) AS product_median FROM amounts GROUP BY product"


@query("a6_group_median", MEDIANS_SQL)
def a6_group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = gold.group_medians(lineage_cut(segment_amounts(spark, sf_dir)))
    return medians.select("product", F.round(gold.MEDIAN, 6).alias(gold.MEDIAN))


@query(
    "a6_group_median_large",
    """SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 6) AS price_median FROM lineitem
    GROUP BY l_returnflag, l_linestatus""",
)
def a6_group_median_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few groups that hold the largest table."""
    lines = table(spark, sf_dir, "lineitem")
    medians = group_quantile(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", 0.5, "price_median")
    return medians.withColumn("price_median", F.round("price_median", 6))


SKETCHED_DAYS = ("1993-03-10", "1996-08-20")
SKETCHED_AT = (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


@query(
    "a6_sketched_quantiles",
    f"""SELECT o_orderpriority, probability, n_values, true AS rank_within, true AS idents_within
    FROM (SELECT o_orderpriority, count(o_totalprice) AS n_values FROM orders
          WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{SKETCHED_DAYS[0]}' AND DATE '{SKETCHED_DAYS[1]}'
          GROUP BY o_orderpriority),
         (SELECT CAST(unnest([{", ".join(map(str, SKETCHED_AT))}]) AS DOUBLE) AS probability)""",
)
def a6_sketched_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored daily sketches merged over a range; each quantile's exact rank among the range's rows is within 1 % of the asked
    one, and each count of customers within 6 %."""
    group, orders = ["o_orderpriority"], table(spark, sf_dir, "orders")
    stored = lineage_cut(daily_sketches(orders, group, "o_orderdate", "o_totalprice", "o_custkey"))
    states = lineage_cut(over_days(stored, group, *SKETCHED_DAYS))
    days = orders.filter(F.to_date("o_orderdate").between(*(F.lit(d).cast("date") for d in SKETCHED_DAYS)))
    exact = days.groupBy(*group).agg(F.countDistinct("o_custkey").alias("customers"))
    found = lineage_cut(sketched_quantiles(states, group, SKETCHED_AT))
    ranked = days.join(found, group).groupBy(*group, "probability").agg(
        F.count_if(F.col("o_totalprice") < F.col("value")).alias("below"),
        F.count_if(F.col("o_totalprice") <= F.col("value")).alias("reached"),
    )
    n, at = F.col("n_values"), F.col("probability")
    # a value has all the ranks of its copies; one row is the finest step
    close = (F.col("below") <= (at + 0.01) * n + 1) & (F.col("reached") >= (at - 0.01) * n - 1)
    counted = F.abs(F.col("idents") - F.col("customers")) <= 0.06 * F.col("customers")
    return (
        ranked.join(states.select(*group, "n_values"), group)
        .join(sketched_distinct(states, group), group)
        .join(exact, group)
        .select(*group, "probability", "n_values", close.alias("rank_within"), counted.alias("idents_within"))
    )


@query(
    "a7_rate_by_group",
    f"""WITH {RECORDS}, g AS (SELECT product, count(*) AS n, sum(is_fraud) AS frauds,
      CAST(sum(CAST(claim_amount AS DECIMAL(18, 2))) * 100 AS HUGEINT) AS cents FROM records GROUP BY product)
    SELECT product, n AS claims, CAST(frauds AS BIGINT) AS fraud_cases, {half_up("frauds * 100", "n", 2)} AS fraud_rate_pct,
           {half_up("cents", "n * 100", 0)} AS avg_amount FROM g""",
)
def a7_rate_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rate_by_group(gold.claim_records(*silver(spark, sf_dir)))


@query(
    "a8_weighted_rollup",
    f"""WITH {MONTHLY}, m AS (
      SELECT month, sum(n_claims) AS n, CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) * 100 AS HUGEINT) AS cents,
             CAST(sum(CAST(fraud_rate AS DECIMAL(9, 4)) * n_claims) * 10000 AS HUGEINT) AS weighted
      FROM monthly GROUP BY month)
    SELECT CAST(month AS VARCHAR) AS month, CAST(n AS BIGINT) AS claims, {half_up("cents", "100", 0)} AS total_cost,
           {half_up("weighted", "n * 100", 2)} AS fraud_rate_pct FROM m""",
)
def a8_weighted_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text_dates(gold.monthly_rollup(monthly(spark, sf_dir)))


@query(
    "a9_quarantine_reasons",
    f"""WITH {CHECKED_CLAIMS} SELECT rule, count(*) AS "rows" FROM (
      SELECT unnest(string_split(failed_rules, ',')) AS rule FROM claims_checked WHERE failed_rules <> '')
    GROUP BY rule""",
)
def a9_quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_reasons(split_valid(checked_claims(spark, sf_dir))[1])


@query(
    "a10_conservation",
    f"""WITH {CLEAN_CLAIMS}, c AS (SELECT claim_id, {hit_sql("keyless", 0.02, "claim_id")} AS keyless FROM claims_copies)
    SELECT count(DISTINCT claim_id) FILTER (WHERE NOT keyless) AS distinct_keys, count(*) FILTER (WHERE keyless) AS keyless_rows,
           count(DISTINCT claim_id) FILTER (WHERE NOT keyless) AS valid_rows, count(*) FILTER (WHERE keyless) AS quarantined_rows,
           true AS conserved FROM c""",
)
def a10_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a claim count once, claims without a key one by one."""
    keyed = F.when(~chosen("keyless", 0.02, "claim_id"), F.col("claim_id"))
    claims = clean_claims(spark, sf_dir).withColumn("claim_id", keyed)
    return conservation(claims, "claim_id", apply_rules(dedupe(claims, ["claim_id"]), (KEY_PRESENT,)))


# --- features ----------------------------------------------------------------------------------------------------


def features(spark: SparkSession, sf_dir: str, feeds: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    return gold.fraud_features(*silver(spark, sf_dir, feeds))


@query("f1_features", f"WITH {FEATURE_ROWS} SELECT * FROM features")
def f1_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir)


@query(
    "f4_ratio_to_group_median",
    f"""WITH {AMOUNTS}, m AS (SELECT product, median(claim_amount) AS product_median FROM amounts GROUP BY product)
    SELECT claim_id, product, {round_sql("claim_amount / product_median", 3)} AS ratio FROM amounts JOIN m USING (product)""",
)
def f4_ratio_to_group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = lineage_cut(segment_amounts(spark, sf_dir))
    with_median = gold.with_group_statistic(amounts, gold.group_medians(amounts))
    return with_median.select("claim_id", "product", gold.ratio("claim_amount", gold.MEDIAN).alias("ratio"))


@query(
    "w1_window_median",
    f"""WITH {AMOUNTS} SELECT claim_id, product,
    round(median(claim_amount) OVER (PARTITION BY product), 6) AS product_median FROM amounts""",
)
def w1_window_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole-partition window statistic, as group statistic plus lookup."""
    amounts = lineage_cut(segment_amounts(spark, sf_dir))
    with_median = gold.with_group_statistic(amounts, gold.group_medians(amounts))
    return with_median.select("claim_id", "product", F.round(gold.MEDIAN, 6).alias(gold.MEDIAN))


SERVING_SELECT = f"""claim_id, r.product, region, channel, CAST(customer_age AS DOUBLE) AS customer_age, claim_amount,
  annual_premium, CAST(datediff('day', start_date, incident_date) AS DOUBLE) AS days_since_policy_start,
  CAST(datediff('day', incident_date, report_date) AS DOUBLE) AS report_delay_days,
  {round_sql("claim_amount / product_median", 3)} AS amount_vs_product_median,
  {round_sql("claim_amount / annual_premium", 3)} AS amount_vs_premium"""


@query(
    "f7_serving_features",
    f"""WITH {RECORDS}, m AS (SELECT product, median(claim_amount) AS product_median FROM records WHERE is_fraud = 0
      GROUP BY product)
    SELECT {SERVING_SELECT}, is_fraud FROM records r JOIN m ON r.product = m.product""",
)
def f7_serving_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features relative to medians that were frozen earlier, here those of the honest claims."""
    records = lineage_cut(gold.claim_records(*silver(spark, sf_dir)))
    medians = gold.group_medians(records.filter("is_fraud = 0"))
    return as_double(gold.claim_features(records, medians), gold.NUMERIC)


@query(
    "e5_skew_check",
    f"""WITH {RECORDS} SELECT c AS "column", CAST(0 AS BIGINT) AS mismatches, (SELECT count(*) FROM records) AS compared,
      CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, CAST(0 AS BIGINT) AS copies_left,
      CAST(0 AS BIGINT) AS copies_right
    FROM (VALUES {", ".join(f"('{c}')" for c in gold.FEATURES)}) columns(c)""",
)
def e5_skew_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training features against the features serving computes from stored medians and untidy requests."""
    claims, policies = silver(spark, sf_dir)
    records = lineage_cut(gold.claim_records(claims, policies))
    trained = gold.fraud_features(claims, policies)
    medians = lineage_cut(gold.group_medians(records))
    untidy = normalise_requests(records.withColumn("product", F.concat(F.lit(" "), F.upper("product"))))
    served = gold.claim_features(untidy, medians)
    return reconcile(trained, served, ["claim_id"], gold.FEATURES)


@query(
    "p12_feature_types",
    f"""WITH {FEATURE_ROWS} SELECT claim_id, CAST(customer_age AS DOUBLE) AS customer_age, claim_amount, annual_premium,
    CAST(days_since_policy_start AS DOUBLE) AS days_since_policy_start,
    CAST(report_delay_days AS DOUBLE) AS report_delay_days, amount_vs_product_median, amount_vs_premium FROM features""",
)
def p12_feature_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(features(spark, sf_dir), gold.NUMERIC).select("claim_id", *gold.NUMERIC)


@query(
    "p14_unknown_category",
    f"""WITH {AMOUNTS}, m AS (SELECT product, median(claim_amount) AS product_median FROM amounts
      WHERE product <> 'furniture' GROUP BY product)
    SELECT a.product, CASE WHEN product_median IS NULL THEN 'stat_known' ELSE '' END AS failed_rules, count(*) AS n
    FROM amounts a LEFT JOIN m ON a.product = m.product GROUP BY 1, 2""",
)
def p14_unknown_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a product for which no median was learnt are quarantined, not guessed."""
    amounts = lineage_cut(segment_amounts(spark, sf_dir))
    medians = gold.group_medians(amounts.filter("product <> 'furniture'"))
    checked = apply_rules(
        gold.with_group_statistic(amounts, medians), [Rule("stat_known", f"{gold.MEDIAN} IS NOT NULL")]
    )
    return checked.groupBy("product", reasons()).agg(F.count(F.lit(1)).alias("n"))


RISK_SQL = """1 / (1 + exp(-(-4.0 + CASE WHEN days_since_policy_start < 200 THEN 1.8 ELSE 0.0 END
  + CASE WHEN amount_vs_product_median > 1.6 THEN 2.0 ELSE 0.0 END
  + CASE WHEN report_delay_days > 1500 THEN 1.2 ELSE 0.0 END)))"""


@query(
    "f8_risk_score",
    f"WITH {FEATURE_ROWS} SELECT claim_id, round({RISK_SQL}, 8) AS risk FROM features",
)
def f8_risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).select("claim_id", F.round(risk(), 8).alias("risk"))


def risk() -> F.Column:
    """The red-flag score, with limits that suit the dates and amounts of the given tables."""
    return gold.red_flag_score(
        "days_since_policy_start < 200", "amount_vs_product_median > 1.6", "report_delay_days > 1500"
    )


@query(
    "t4_sample",
    f"""WITH {CHECKED_CLAIMS} SELECT claim_id, policy_id, claim_amount, CAST(incident_date AS VARCHAR) AS incident_date,
      CAST(report_date AS VARCHAR) AS report_date, failed_rules
    FROM claims_checked WHERE failed_rules <> '' ORDER BY claim_id LIMIT 20""",
)
def t4_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty quarantined claims by id."""
    _, bad = split_valid(checked_claims(spark, sf_dir))
    columns = ("claim_id", "policy_id", "claim_amount", *CLAIM_DATES)
    return with_text_dates(bad.select(*columns, reasons()).orderBy("claim_id").limit(20))


@query(
    "f2_days_between",
    """SELECT l_orderkey, l_linenumber, count(*) AS n, CAST(min(datediff('day', o_orderdate, l_shipdate)) AS INTEGER) AS least_days,
      CAST(max(datediff('day', o_orderdate, l_shipdate)) AS INTEGER) AS most_days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def f2_days_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = joined_by_key(table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_shipdate"), "l_orderkey", orders, "o_orderkey")
    days = days_between("l_shipdate", "o_orderdate")
    return lines.groupBy(*LINE_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min(days).alias("least_days"), F.max(days).alias("most_days")
    )

