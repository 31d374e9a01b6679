"""Serving views over the Gold tables.

Rates in Gold are already rounded, and the views average those rounded rates, as
the reports define them.  The Gold keys are unique, so counting rows of a key
counts distinct customers.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact as X
from ..functions.casting import as_column

C360_PROFILE = [
    "customer_id", "segment", "plan_type", "plan_name", "region", "tenure_band",
    "age_band", "churn_risk", "is_high_value", "monthly_fee_qar",
]


def probability(c="churn_probability"):
    """Churn probability as decimal, so that sums do not depend on task order."""
    return as_column(c).cast("decimal(12,9)")


def vw_executive_kpis(summary: DataFrame) -> DataFrame:
    high_risk = F.count_if(F.col("churn_risk") == "High")
    return summary.agg(
        F.count("customer_id").alias("total_customers"),
        X.mean_round("avg_monthly_arpu", 20, 2).alias("overall_arpu_qar"),
        X.rounded(F.sum("total_cdr_revenue"), 24, 2).alias("total_revenue_qar"),
        X.mean_round("call_drop_rate_pct", 9, 2).alias("avg_drop_rate_pct"),
        X.mean_round("total_data_gb", 20, 3).alias("avg_data_gb_per_customer"),
        high_risk.alias("high_churn_customers"),
        F.count_if(F.col("is_high_value") == 1).alias("high_value_customers"),
        X.pct_round(high_risk, F.count("*")).alias("churn_risk_pct"),
    )


def vw_arpu_monthly_trend(arpu: DataFrame) -> DataFrame:
    return arpu.groupBy("call_month", "segment", "plan_type", "region").agg(
        F.count("customer_id").alias("customer_count"),
        X.mean_round("total_revenue_qar", 20, 2).alias("avg_arpu"),
        X.rounded(F.sum("total_revenue_qar"), 24, 2).alias("total_revenue"),
        X.mean_round("call_drop_rate_pct", 9, 2).alias("avg_drop_rate"),
        X.mean_round("data_usage_gb", 20, 3).alias("avg_data_gb"),
        F.sum("total_calls").alias("total_calls"),
        F.sum("is_churning_signal").alias("churn_signals"),
    )


def customer_360_core(summary: DataFrame) -> DataFrame:
    return summary.select(
        *C360_PROFILE,
        "active_days",
        "total_cdrs",
        X.rounded("total_cdr_revenue", 20, 2).alias("total_cdr_revenue"),
        X.rounded("total_data_gb", 20, 3).alias("total_data_gb"),
        X.rounded("avg_call_duration", 12, 2).alias("avg_call_duration_min"),
        X.rounded("call_drop_rate_pct", 9, 2).alias("call_drop_rate_pct"),
        "total_recharges",
        X.rounded("total_recharge_amount", 20, 2).alias("total_recharge_amount"),
        X.rounded("avg_monthly_arpu", 20, 2).alias("avg_monthly_arpu"),
    )


def vw_customer_360(summary: DataFrame, scores: DataFrame) -> DataFrame:
    scored = scores.select(
        "customer_id",
        X.rounded(probability() * 100, 5, 1).alias("churn_probability_pct"),
        "churn_score_band",
        "is_high_churn_risk",
    )
    return customer_360_core(summary).join(scored, "customer_id", "left")


def vw_regional_performance(regional: DataFrame, weighted: bool = False) -> DataFrame:
    """Regions, from the region and segment table.

    The averages are means over segments, each with equal weight;
    ``weighted=True`` adds duration and drop rate weighted by calls and revenue
    weighted by customers.
    """
    extra = []
    if weighted:
        calls, people = F.col("total_calls"), F.col("customer_count")
        extra = [
            X.div_round(F.sum(F.col("avg_duration_min") * calls), F.sum(calls), 12, 2).alias(
                "weighted_call_duration"
            ),
            X.div_round(F.sum(F.col("call_drop_rate_pct") * calls), F.sum(calls), 9, 2).alias(
                "weighted_drop_rate"
            ),
            X.div_round(F.sum("total_cdr_revenue"), F.sum(people), 20, 2).alias(
                "weighted_revenue_per_customer"
            ),
        ]
    return regional.groupBy("region").agg(
        F.sum("customer_count").alias("total_customers"),
        X.rounded(F.sum("total_cdr_revenue"), 24, 2).alias("total_revenue"),
        X.mean_round("avg_duration_min", 12, 2).alias("avg_call_duration"),
        X.mean_round("call_drop_rate_pct", 9, 2).alias("avg_drop_rate"),
        X.rounded(F.sum("total_data_gb"), 24, 2).alias("total_data_gb"),
        X.mean_round("revenue_per_customer", 20, 2).alias("avg_revenue_per_customer"),
        *extra,
    )


def vw_churn_analysis(scores: DataFrame, summary: DataFrame) -> DataFrame:
    """Score bands; tenure, calls and drop rate come from the scores table, fee and
    recharges from the summary."""
    cu = summary.select(
        "customer_id",
        F.col("monthly_fee_qar").alias("cu_fee"),
        F.col("total_recharges").alias("cu_recharges"),
    )
    drop_rate = F.col("drop_rate_pct").cast("decimal(15,9)")
    return (
        scores.join(cu, "customer_id", "left")
        .groupBy("churn_score_band")
        .agg(
            F.count("*").alias("customer_count"),
            X.mean_round(probability(), 6, 4, num_scale=9).alias("avg_churn_prob"),
            X.mean_round("tenure_months", 9, 1).alias("avg_tenure_months"),
            X.mean_round("cu_fee", 20, 2).alias("avg_monthly_fee"),
            F.sum("total_calls").alias("total_calls"),
            X.mean_round(drop_rate, 9, 2, num_scale=9).alias("avg_drop_rate"),
            F.sum("cu_recharges").alias("total_recharges"),
        )
    )
