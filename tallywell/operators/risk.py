"""Rule score, risk bands and what is reported from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Band names with their (open, closed] probability bounds.
RISK_BANDS = [("Low Risk", 0.0, 0.3), ("Medium Risk", 0.3, 0.7), ("High Risk", 0.7, 1.0)]

# Fixed values of the additive rule.
RULE_BASE = 0.1
RULE_CONTRACT = {"Monthly": 0.15, "Annual": 0.05, "Two-year": 0.02}
RULE_PER_CALL = 0.05
RULE_PER_MISSING_SERVICE = 0.05
RULE_PER_LATE_PAYMENT = 0.08
RULE_TENURE = [(6, 0.1), (12, 0.05)]
RULE_TENURE_LONG = 0.02
RULE_CLIP = (0.01, 0.9)

SERVICES = ["service_click", "service_view", "service_purchase", "service_signup"]


def rule_terms() -> dict[str, Column]:
    """The additive terms of the rule, NULL inputs counting as 0."""
    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    contract = F.lit(0.0)
    for name, weight in RULE_CONTRACT.items():
        contract = F.when(F.col("contract_type") == name, weight).otherwise(contract)
    tenure = F.lit(RULE_TENURE_LONG)
    for upper, weight in reversed(RULE_TENURE):
        tenure = F.when(zero("tenure") <= upper, weight).otherwise(tenure)
    calls = F.coalesce(F.try_divide(zero("support_calls").cast("double"), zero("tenure")), F.lit(0.0))
    n_services = zero(SERVICES[0])
    for c in SERVICES[1:]:
        n_services = n_services + zero(c)
    return {
        "contract_type": contract,
        "support_calls_per_month": F.lit(RULE_PER_CALL) * calls,
        "total_services": F.lit(RULE_PER_MISSING_SERVICE) * (4 - n_services),
        "late_payments": F.lit(RULE_PER_LATE_PAYMENT) * zero("late_payments"),
        "tenure": tenure,
    }


def rule_score() -> Column:
    """Sum of the rule terms, clipped, at six decimals."""
    total = F.lit(RULE_BASE)
    for term in rule_terms().values():
        total = total + term
    low, high = RULE_CLIP
    return F.round(F.greatest(F.lit(low), F.least(F.lit(high), total)), 6)


def risk_category(probability: Column) -> Column:
    """Right-closed band of a probability; exactly 0 and NULL have no band."""
    band = F.lit(None).cast("string")
    for name, low, high in RISK_BANDS:
        band = F.when((probability > low) & (probability <= high), name).otherwise(band)
    return band


def with_risk(df: DataFrame, probability: str) -> DataFrame:
    """Append the band of ``probability`` as ``risk_category``."""
    return df.withColumn("risk_category", risk_category(F.col(probability)))


def high_risk(df: DataFrame, band: str = "High Risk") -> DataFrame:
    """Rows in one band."""
    return df.filter(F.col("risk_category") == band)


def risk_distribution(df: DataFrame) -> DataFrame:
    """Customers per band and their share of all rows, empty bands included.

    One conditional-count pass: every task sends a single row.
    """
    counts = df.agg(F.count("*").alias("n"),
                    *[F.count_if(F.col("risk_category") == b).alias(f"b{i}")
                      for i, (b, _, _) in enumerate(RISK_BANDS)])
    rows = F.array(*[F.struct(F.lit(b).alias("risk_category"),
                              F.col(f"b{i}").alias("customers"),
                              F.try_divide(F.col(f"b{i}") * 100.0, F.col("n")).alias("pct"))
                     for i, (b, _, _) in enumerate(RISK_BANDS)])
    return counts.select(F.inline(rows)).withColumn("pct", F.round("pct", 6))


def top_risk(df: DataFrame, probability: str, k: int = 5, id_col: str = "customer_id") -> DataFrame:
    """The ``k`` most probable High Risk rows; ties go to the smaller id."""
    return (high_risk(df).select(id_col, probability, "risk_category")
            .orderBy(F.desc(probability), id_col).limit(k))
