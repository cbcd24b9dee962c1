"""The given tables in the role of raw policy and claim feeds, as Spark frames and as SQL.

Customers play the policies and orders the claims. Both are turned back into untidy text, with a few defects whose rows
the key's hash decides, so that cleaning and rules have work to do on every row of the tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.functions.cleaning import clean
from trustlake.functions.hashing import chosen, share_cut
from trustlake.operators.defects import inject_duplicates
from trustlake.operators.rules import split_valid
from trustlake.plans.datasets import CLAIMS, POLICIES, check, check_typed
from trustlake.session import lineage_cut


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str):
    """A date as text, the same on both engines."""
    return F.col(column).cast("date").cast("string")


def with_text_dates(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema.fields if f.dataType.typeName() == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


def hit_sql(seed: str, share: float, key: str) -> str:
    """SQL of ``chosen``."""
    return f"md5('{seed}|' || {key}) < '{share_cut(share)}'"


def broken_sql(*conditions: tuple[str, str]) -> str:
    """SQL of the names of broken rules, comma separated, from (name, condition that a broken row meets) pairs."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {condition} THEN '{name}' END" for name, condition in conditions) + ")"


# The rules once more, written for the other engine by hand: when a row breaks them.
POLICY_FAILED = broken_sql(
    ("policy_id_present", "policy_id IS NULL"),
    ("start_date_valid", "start_date IS NULL"),
    ("end_after_start", "start_date IS NULL OR end_date IS NULL OR end_date <= start_date"),
    ("premium_positive", "annual_premium IS NULL OR annual_premium <= 0"),
    ("premium_finite", "isnan(annual_premium) OR isinf(annual_premium)"),
)
CLAIM_FAILED = broken_sql(
    ("claim_id_present", "claim_id IS NULL"),
    ("claim_amount_present", "claim_amount IS NULL"),
    ("claim_amount_positive", "claim_amount <= 0"),
    ("incident_date_valid", "incident_date IS NULL"),
    ("reported_after_incident", "report_date IS NULL OR incident_date IS NULL OR report_date < incident_date"),
    ("policy_exists", "NOT _policy_found"),
    ("claim_amount_finite", "isnan(claim_amount) OR isinf(claim_amount)"),
)


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """SQL of a quotient of non-negative integers, rounded half up without floating point."""
    scale = 10**digits
    top, bottom = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"CAST((2 * {top} * {scale} + {bottom}) // (2 * {bottom}) AS DOUBLE) / {scale}.0"


def round_sql(value: str, digits: int) -> str:
    """SQL of rounding the decimal text of a double half up, as Spark does."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


# --- raw feeds ---------------------------------------------------------------------------------------------------


def raw_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    active = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))
    customers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return customers.join(active, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.concat(F.lit("  "), F.col("c_custkey")).alias("policy_id"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("product"),
        F.concat(F.col("r_name"), F.lit(" ")).alias("region"),
        (F.col("c_nationkey") + 18).cast("string").alias("customer_age"),
        day("first_day").alias("start_date"),
        day("last_day").alias("end_date"),
        F.col("c_acctbal").cast("string").alias("annual_premium"),
    )


RAW_POLICIES = """raw_policies AS (
  SELECT '  ' || c_custkey AS policy_id, ' ' || c_mktsegment || ' ' AS product, r_name || ' ' AS region,
         CAST(c_nationkey + 18 AS VARCHAR) AS customer_age,
         CAST(CAST(first_day AS DATE) AS VARCHAR) AS start_date,
         CAST(CAST(last_day AS DATE) AS VARCHAR) AS end_date,
         CAST(c_acctbal AS VARCHAR) AS annual_premium
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day
             FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"""


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    orders = table(spark, sf_dir, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    amount = F.when(chosen("bad-amount", 0.01, "o_orderkey"), F.lit("abc")).otherwise(F.col("o_totalprice").cast("string"))
    channel = F.when(~chosen("no-channel", 0.01, "o_orderkey"), F.concat(F.lit(" "), F.col("o_orderpriority")))
    claims = orders.select(
        F.concat(F.lit(" "), F.col("o_orderkey")).alias("claim_id"),
        F.concat(F.col("o_custkey"), F.lit(" ")).alias("policy_id"),
        day("o_orderdate").alias("incident_date"),
        day("last_ship").alias("report_date"),
        amount.alias("claim_amount"),
        channel.alias("channel"),
        F.concat(F.lit("order with status "), F.col("o_orderstatus")).alias("description"),
        (F.col("o_orderstatus") == "F").cast("int").cast("string").alias("is_fraud"),
    )
    return inject_duplicates(claims, "claim_id")


RAW_CLAIMS = f"""single_claims AS (
  SELECT ' ' || o_orderkey AS claim_id, o_custkey || ' ' AS policy_id,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS incident_date,
         CAST(CAST(last_ship AS DATE) AS VARCHAR) AS report_date,
         CASE WHEN {hit_sql("bad-amount", 0.01, "o_orderkey")} THEN 'abc'
              ELSE CAST(o_totalprice AS VARCHAR) END AS claim_amount,
         CASE WHEN NOT {hit_sql("no-channel", 0.01, "o_orderkey")} THEN ' ' || o_orderpriority END AS channel,
         'order with status ' || o_orderstatus AS description,
         CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS is_fraud
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey)
  ON o_orderkey = l_orderkey),
raw_claims AS (
  SELECT * FROM single_claims
  UNION ALL SELECT * FROM single_claims WHERE {hit_sql("42|d6", 0.01, "claim_id")})"""


# --- typed, checked, valid ---------------------------------------------------------------------------------------


def clean_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_policies(spark, sf_dir), POLICIES.columns)


def clean_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_claims(spark, sf_dir), CLAIMS.columns)


def checked_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(POLICIES, raw_policies(spark, sf_dir))


def valid_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_valid(checked_policies(spark, sf_dir))[0].drop("_copies")


def checked_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(CLAIMS, raw_claims(spark, sf_dir), {"policies": valid_policies(spark, sf_dir)})


def stored_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Typed claims and policies, stored once: for queries that train on the feeds and read requests from them, too."""
    return lineage_cut(clean_claims(spark, sf_dir)), lineage_cut(clean_policies(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, feeds: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid claims and policies, each computed and stored once, as the silver layer is."""
    claims, policies = feeds or (clean_claims(spark, sf_dir), clean_policies(spark, sf_dir))
    policies = lineage_cut(split_valid(check_typed(POLICIES, policies))[0].drop("_copies"))
    checked = check_typed(CLAIMS, claims, {"policies": policies})
    return lineage_cut(split_valid(checked)[0].drop("_copies")), policies


CLEAN_POLICIES = f"""{RAW_POLICIES},
policies_all AS (
  SELECT trim(policy_id) AS policy_id, lower(trim(product)) AS product, trim(region) AS region,
         TRY_CAST(trim(customer_age) AS INTEGER) AS customer_age, TRY_CAST(trim(start_date) AS DATE) AS start_date,
         TRY_CAST(trim(end_date) AS DATE) AS end_date, TRY_CAST(trim(annual_premium) AS DOUBLE) AS annual_premium
  FROM raw_policies)"""

CHECKED_POLICIES = f"""{CLEAN_POLICIES},
policies_checked AS (SELECT *, {POLICY_FAILED} AS failed_rules FROM policies_all),
policies AS (SELECT * EXCLUDE (failed_rules) FROM policies_checked WHERE failed_rules = '')"""

CLEAN_CLAIMS = f"""{RAW_CLAIMS},
claims_copies AS (
  SELECT trim(claim_id) AS claim_id, trim(policy_id) AS policy_id, TRY_CAST(trim(incident_date) AS DATE) AS incident_date,
         TRY_CAST(trim(report_date) AS DATE) AS report_date, TRY_CAST(trim(claim_amount) AS DOUBLE) AS claim_amount,
         coalesce(lower(trim(channel)), 'unknown') AS channel, trim(description) AS description,
         TRY_CAST(trim(is_fraud) AS INTEGER) AS is_fraud
  FROM raw_claims),
claims_all AS (SELECT DISTINCT * FROM claims_copies)"""

CHECKED_CLAIMS = f"""{CHECKED_POLICIES}, {CLEAN_CLAIMS},
claims_marked AS (SELECT claims_all.*, policies.policy_id IS NOT NULL AS _policy_found
                  FROM claims_all LEFT JOIN policies ON claims_all.policy_id = policies.policy_id),
claims_checked AS (SELECT * EXCLUDE (_policy_found), {CLAIM_FAILED} AS failed_rules
                   FROM claims_marked),
claims AS (SELECT * EXCLUDE (failed_rules) FROM claims_checked WHERE failed_rules = '')"""

# claims with their policy's columns
RECORDS = f"""{CHECKED_CLAIMS},
records AS (SELECT claims.*, product, region, customer_age, start_date, end_date, annual_premium
            FROM claims JOIN policies ON claims.policy_id = policies.policy_id)"""

FEATURE_ROWS = f"""{RECORDS},
features AS (
  SELECT claim_id, product, region, channel, customer_age, claim_amount, annual_premium,
         CAST(datediff('day', start_date, incident_date) AS INTEGER) AS days_since_policy_start,
         CAST(datediff('day', incident_date, report_date) AS INTEGER) AS report_delay_days,
         {round_sql("claim_amount / median(claim_amount) OVER (PARTITION BY product)", 3)} AS amount_vs_product_median,
         {round_sql("claim_amount / annual_premium", 3)} AS amount_vs_premium, is_fraud
  FROM records)"""


def text_dates_sql(columns: Sequence[str], dates: Sequence[str]) -> str:
    """SELECT list with the dates as text."""
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in dates else c for c in columns)
