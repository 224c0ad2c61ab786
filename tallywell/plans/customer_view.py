"""Customer feature view and its rule-scored extension, one row per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.operators.risk import rule_score
from tallywell.sources.tables import table

CUTOFF = "2000-08-01 00:00:00"

CONTRACT_BY_SEGMENT = {
    "AUTOMOBILE": "Monthly",
    "BUILDING": "Monthly",
    "FURNITURE": "Monthly",
    "HOUSEHOLD": "Annual",
    "MACHINERY": "Two-year",
}

SERVICE_EVENTS = ["click", "view", "purchase", "signup"]

NUMERIC = ["c_acctbal", "tenure", "contract_duration", "revenue", "cost", "late_payments",
           "usage_frequency", "support_calls", "service_click", "service_view",
           "service_purchase", "service_signup"]
CATEGORICAL = ["region", "contract_type", "last_event_type"]


def _order_facts(spark: SparkSession, base: str) -> DataFrame:
    # Lines are summed per order before the join, so an order with very many
    # lines reaches the join as one row; customers are summed map-side first.
    line_cost = (table(spark, base, "lineitem")
                 .groupBy("l_orderkey")
                 .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_cost")))
    past = F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")
    day = F.when(past, F.col("o_orderdate").cast("date"))
    month = F.when(past, F.year("o_orderdate") * 12 + F.month("o_orderdate"))
    return (table(spark, base, "orders")
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
            .join(line_cost, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .groupBy("o_custkey")
            .agg(F.count_if(past).alias("n_past"),
                 F.count_if(~past).alias("n_later"),
                 F.floor(F.datediff(F.max(day), F.min(day)) / 30).alias("tenure"),
                 F.count_distinct(month).alias("n_months"),
                 F.round(F.sum(F.when(past, F.col("o_totalprice"))), 2).alias("revenue"),
                 F.round(F.sum(F.when(past, F.col("line_cost"))), 4).alias("cost"),
                 F.count_if(past & (F.col("o_orderstatus") == "P")).alias("n_late")))


def _event_facts(spark: SparkSession, base: str) -> DataFrame:
    kind = F.col("event_type")
    flags = [F.max((kind == e).cast("int")).alias(f"service_{e}") for e in SERVICE_EVENTS]
    return (table(spark, base, "events")
            .groupBy("user_id")
            .agg(F.count("*").alias("usage_frequency"),
                 F.count_if(kind == "error").alias("support_calls"),
                 F.max_by("event_type", F.struct("ts", "event_id")).alias("last_event_type"),
                 *flags))


def customer_features(spark: SparkSession, base: str) -> DataFrame:
    """One row per customer: profile, order history before the cut-off, event
    usage, and ``Churn`` = no order on or after the cut-off."""
    segment = F.col("c_mktsegment")
    contract = F.lit(None).cast("string")
    for seg, name in CONTRACT_BY_SEGMENT.items():
        contract = F.when(segment == seg, name).otherwise(contract)
    has_past = F.col("n_past") > 0
    return (table(spark, base, "customer")
            .join(table(spark, base, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, base, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .join(_order_facts(spark, base), F.col("c_custkey") == F.col("o_custkey"), "left")
            .join(_event_facts(spark, base), F.col("c_custkey") == F.col("user_id"), "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("r_name").alias("region"),
                contract.alias("contract_type"),
                "c_acctbal",
                F.col("tenure").cast("bigint").alias("tenure"),
                F.when(has_past, F.col("n_months")).alias("contract_duration"),
                "revenue",
                "cost",
                F.when(has_past, F.least(F.lit(5), F.col("n_late"))).cast("bigint").alias("late_payments"),
                "usage_frequency",
                "support_calls",
                *[f"service_{e}" for e in SERVICE_EVENTS],
                "last_event_type",
                F.when(F.coalesce("n_later", F.lit(0)) == 0, 1).otherwise(0).alias("Churn")))


def scored_customers(spark: SparkSession, base: str) -> DataFrame:
    """The feature view with the deterministic rule score, its 0/1 prediction
    and the learnable label ``label_sig``."""
    df = customer_features(spark, base).withColumn("rule_score", rule_score())
    return df.withColumns({
        "pred": F.when(F.col("rule_score") >= 0.5, 1).otherwise(0),
        "label_sig": F.when(F.col("rule_score") >= 0.6, 1).otherwise(0)})
