"""Gold KPI tables.

They start from usage rows: Silver CDRs as keys and additive measures
(:func:`usage_rows`), or any rollup of them (:func:`roll_up`).  Distinct counts are
taken by rolling up to the counted column first, so every step aggregates before
its shuffle and one busy customer costs a handful of rows per task.  A job that
builds several Gold tables stores :func:`usage_daily` once and derives them from
it instead of scanning the CDRs for each.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact as X
from ..functions.codes import flag, segment_code

ARPU_PROFILE = [
    "customer_id", "segment", "plan_type", "plan_name", "monthly_fee_qar", "region",
    "tenure_months", "age_band", "tenure_band", "is_high_value", "churn_risk",
]
SUMMARY_PROFILE = [
    "customer_id", "segment", "plan_type", "plan_name", "monthly_fee_qar", "region",
    "tenure_months", "tenure_band", "age_band", "churn_risk", "is_high_value",
    "activation_date",
]
FEATURE_PROFILE = [
    "customer_id", "churn_risk", "tenure_months", "monthly_fee_qar", "data_allowance_gb", "plan_type", "segment",
]
USAGE_KEYS = ["customer_id", "call_date", "call_month", "network_type"]
COUNTS = [
    "calls", "cdr_ids", "timed_calls", "voice", "data_sessions", "sms", "dropped",
    "roaming", "peak", "calls_5g", "calls_4g",
]
SUMS = {"minutes": (22, 2), "mb": (22, 2), "revenue": (20, 3)}


def usage_rows(cdr: DataFrame) -> DataFrame:
    """Silver CDRs as usage keys and measures, one row per CDR."""

    def one_if(condition):
        return flag(condition).cast("bigint")

    network = F.col("network_type")
    measures = {
        "calls": F.lit(1).cast("bigint"),
        "cdr_ids": one_if(F.col("cdr_id").isNotNull()),
        "timed_calls": one_if(F.col("duration_minutes").isNotNull()),
        "voice": F.col("is_voice").cast("bigint"),
        "data_sessions": F.col("is_data_session").cast("bigint"),
        "sms": one_if(F.col("call_type") == "SMS"),
        "dropped": F.col("is_dropped").cast("bigint"),
        "roaming": one_if(F.col("is_roaming") == 1),
        "peak": F.col("is_peak_hour").cast("bigint"),
        "calls_5g": one_if(network == "5G"),
        "calls_4g": one_if(network == "4G"),
        "minutes": F.col("duration_minutes"),
        "mb": F.col("data_consumed_mb"),
        "revenue": F.col("revenue_qar"),
        "last_date": F.col("call_date"),
    }
    return cdr.select(*USAGE_KEYS, *[c.alias(name) for name, c in measures.items()])


def roll_up(usage: DataFrame, *keys: str) -> DataFrame:
    """Usage rows or a finer rollup, summed to the given keys."""
    return usage.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        *[X.total(c, p, s).alias(c) for c, (p, s) in SUMS.items()],
        F.max("last_date").alias("last_date"),
    )


def usage_daily(cdr: DataFrame) -> DataFrame:
    """The stored rollup: one row per customer, day and network."""
    return roll_up(usage_rows(cdr), *USAGE_KEYS)


def cdr_monthly(usage: DataFrame, zero_fill: bool = False) -> DataFrame:
    """Usage per customer and month.

    The conditional counts are NULL when nothing matched, except ``voice_calls``;
    ``zero_fill`` makes them 0.
    """

    def some(name):
        return F.sum(name) if zero_fill else X.null_if_zero(F.sum(name))

    # by customer alone, so that a join with customers needs no further shuffle; a customer is a few rows a month
    by_network = roll_up(usage, "customer_id", "call_month", "network_type").repartition("customer_id")
    return by_network.groupBy("customer_id", "call_month").agg(
        F.sum("calls").alias("total_calls"),
        F.sum("voice").alias("voice_calls"),
        some("data_sessions").alias("data_sessions"),
        some("sms").alias("sms_count"),
        some("dropped").alias("dropped_calls"),
        some("roaming").alias("roaming_calls"),
        X.total("minutes", 20, 2).alias("total_duration_min"),
        X.total("mb", 20, 2).alias("total_data_mb"),
        X.total("revenue", 20, 3).alias("cdr_revenue_qar"),
        X.div_round(F.sum("minutes"), F.sum("timed_calls"), 12, 2).alias("avg_call_duration_min"),
        F.count("network_type").alias("network_types_used"),
        F.max("last_date").alias("last_call_date"),
    )


def recharge_monthly(recharges: DataFrame, zero_fill: bool = False) -> DataFrame:
    digital = F.sum("is_digital_channel")
    return recharges.groupBy("customer_id", F.col("recharge_month").alias("call_month")).agg(
        F.count("*").alias("recharge_count"),
        X.total("recharge_amount", 20, 2).alias("recharge_revenue_qar"),
        X.mean("recharge_amount").alias("avg_recharge_amount"),
        (digital if zero_fill else X.null_if_zero(digital)).alias("digital_recharges"),
    )


def gold_arpu(monthly: DataFrame, recharge: DataFrame, customers: DataFrame) -> DataFrame:
    """ARPU per customer and month: usage, recharge revenue and plan fee.

    Months with recharges but no calls do not appear, and customers missing from
    Silver keep their usage with NULL attributes.  The recharges have one row per
    customer and month; the join sides are aggregates, so no key is hot; Spark broadcasts the customers when
    their size allows it.
    """
    return arpu_measures(arpu_parts(monthly, recharge, customers))


def arpu_parts(monthly: DataFrame, recharge: DataFrame, customers: DataFrame) -> DataFrame:
    """Usage, recharges and profile per customer and month, of which :func:`arpu_measures` makes the rest."""
    values = [c for c in recharge.columns if c not in ("customer_id", "call_month")]
    entry = F.struct("call_month", F.struct(*values))
    by_month = F.map_from_entries(F.collect_list(entry)).alias("__months")
    # a customer's recharged months as one row, so that both joins are by customer and the usage moves for neither
    recharged = recharge.where(F.col("call_month").isNotNull()).groupBy("customer_id").agg(by_month)
    profile = customers.select(*ARPU_PROFILE)
    joined = monthly.join(recharged, "customer_id", "left").join(profile, "customer_id", "left")
    own = F.col("__months")[F.col("call_month")]
    return joined.select(
        *monthly.columns, *[own[c].alias(c) for c in values], *[c for c in profile.columns if c != "customer_id"]
    )


def arpu_measures(parts: DataFrame) -> DataFrame:
    """ARPU and rates, row by row, so that they need not move with the rows."""
    zero = F.lit(0).cast("decimal(20,2)")
    recharged = F.coalesce("recharge_revenue_qar", zero)
    fee = F.coalesce(F.col("monthly_fee_qar").cast("decimal(20,2)"), zero)
    calls = F.col("total_calls")
    return parts.withColumns(
        {
            "recharge_revenue_qar": recharged,
            "recharge_count": F.coalesce("recharge_count", F.lit(0)),
            "total_revenue_qar": X.rounded(F.col("cdr_revenue_qar") + recharged + fee, 20, 2),
            "call_drop_rate_pct": F.when(calls > 0, X.pct_round("dropped_calls", calls)).otherwise(
                F.lit(0).cast("decimal(9,2)")
            ),
            "data_usage_gb": X.div_round("total_data_mb", F.lit(1024), 20, 3),
            "is_churning_signal": flag((F.col("churn_risk") == "High") & (calls < 5)),
        }
    )


def usage_by_customer(usage: DataFrame) -> DataFrame:
    """Usage totals and active days per customer."""
    by_day = roll_up(usage, "customer_id", "call_date")
    return by_day.groupBy("customer_id").agg(
        F.count("call_date").alias("days"),
        *[F.sum(c).alias(c) for c in COUNTS],
        *[X.total(c, p, s).alias(c) for c, (p, s) in SUMS.items()],
    )


def recharges_by_customer(recharges: DataFrame) -> DataFrame:
    """Recharge totals; Silver keys are unique, so counting ids counts distinct ids."""
    return recharges.groupBy("customer_id").agg(
        F.count("*").alias("recharge_rows"),
        F.count("recharge_id").alias("recharge_ids"),
        X.total("recharge_amount", 20, 2).alias("recharged"),
        F.sum("is_digital_channel").alias("digital"),
    )


def customer_facts(customers: DataFrame, usage: DataFrame, recharges: DataFrame) -> DataFrame:
    """Customers with their usage and recharge totals, one row per customer.

    Each side is aggregated before the join, so CDRs and recharges do not multiply
    each other.
    """
    return customers.join(usage_by_customer(usage), "customer_id", "left").join(
        recharges_by_customer(recharges), "customer_id", "left"
    )


def _multiplied(facts: DataFrame) -> DataFrame:
    """The totals a three-way join of customers, CDRs and recharges would give.

    Such a join repeats every CDR once per recharge of the customer and the other
    way round, so sums and counts grow by the size of the other side.  Multiplying
    gives the same numbers without producing the pairs.
    """
    per_cdr = F.greatest(F.coalesce("recharge_rows", F.lit(0)), F.lit(1))
    per_recharge = F.greatest(F.coalesce("calls", F.lit(0)), F.lit(1))
    counts = ["cdr_ids", "calls", "timed_calls", "dropped", "roaming", "peak", "calls_5g"]
    sums = {"minutes": 2, "mb": 2, "revenue": 3}
    grown = {c: F.col(c) * per_cdr for c in counts}
    grown |= {c: (F.col(c) * per_cdr.cast("decimal(14,0)")).cast(f"decimal(24,{s})") for c, s in sums.items()}
    grown["recharged"] = (F.col("recharged") * per_recharge.cast("decimal(14,0)")).cast("decimal(24,2)")
    grown["digital"] = F.col("digital") * per_recharge
    grown["recharge_rows_seen"] = F.col("recharge_rows") * per_recharge
    return facts.withColumns(grown)


def customer_summary(
    customers: DataFrame,
    usage: DataFrame,
    recharges: DataFrame,
    months: int = 3,
    fanout: bool = False,
) -> DataFrame:
    """All-time KPIs per customer.

    ``fanout=True`` gives the totals of the plain three-way join instead (see
    :func:`_multiplied`).  ARPU is NULL for a customer without calls.
    """
    facts = customer_facts(customers.select(*SUMMARY_PROFILE), usage, recharges)
    return facts_summary(_multiplied(facts) if fanout else facts, months)


def facts_summary(facts: DataFrame, months: int = 3) -> DataFrame:
    """The KPIs from rows of :func:`customer_facts`."""
    zero = F.lit(0).cast("decimal(24,2)")
    revenue = (
        F.col("revenue").cast("decimal(24,3)")
        + F.coalesce(F.col("recharged").cast("decimal(24,2)"), zero)
        + F.col("monthly_fee_qar") * months
    )
    return facts.select(
        *SUMMARY_PROFILE,
        F.coalesce("days", F.lit(0)).alias("active_days"),
        F.coalesce("cdr_ids", F.lit(0)).alias("total_cdrs"),
        X.rounded("revenue", 20, 2).alias("total_cdr_revenue"),
        X.div_round("mb", F.lit(1024), 20, 3).alias("total_data_gb"),
        X.div_round("minutes", "timed_calls", 12, 2).alias("avg_call_duration"),
        X.pct_round("dropped", "cdr_ids").alias("call_drop_rate_pct"),
        F.coalesce("recharge_ids", F.lit(0)).alias("total_recharges"),
        X.rounded("recharged", 20, 2).alias("total_recharge_amount"),
        X.div_round(revenue, F.lit(months), 20, 2).alias("avg_monthly_arpu"),
    )


def regional_kpis(customers: DataFrame, usage: DataFrame, ordered: bool = True) -> DataFrame:
    """KPIs per region and segment, best revenue first unless they are only to be stored."""
    facts = customers.select("customer_id", "region", "segment").join(
        roll_up(usage, "customer_id"), "customer_id", "left"
    )
    calls = F.sum(F.coalesce("cdr_ids", F.lit(0)))
    customers_seen = F.count("customer_id")
    kpis = (
        facts.groupBy("region", "segment")
        .agg(
            customers_seen.alias("customer_count"),
            calls.alias("total_calls"),
            X.rounded(F.sum("revenue"), 20, 2).alias("total_cdr_revenue"),
            X.div_round(F.sum("minutes"), F.sum("timed_calls"), 12, 2).alias("avg_duration_min"),
            X.div_round(F.sum("mb"), F.lit(1024), 20, 2).alias("total_data_gb"),
            X.pct_round(F.sum("dropped"), calls).alias("call_drop_rate_pct"),
            X.div_round(F.sum("revenue"), customers_seen, 20, 2).alias("revenue_per_customer"),
        )
    )
    return kpis.orderBy(F.desc("total_cdr_revenue"), "region", "segment") if ordered else kpis


def daily_trend(usage: DataFrame, zero_fill: bool = False, ordered: bool = True) -> DataFrame:
    def some(c):
        return F.coalesce(c, F.lit(0)) if zero_fill else X.null_if_zero(c)

    by_customer = roll_up(usage, "call_date", "call_month", "customer_id")
    days = (
        by_customer.groupBy("call_date", "call_month")
        .agg(
            F.sum("calls").alias("total_calls"),
            F.count("customer_id").alias("active_customers"),
            X.rounded(F.sum("revenue"), 20, 2).alias("daily_revenue"),
            X.div_round(F.sum("mb"), F.lit(1024), 20, 2).alias("daily_data_gb"),
            X.div_round(F.sum("minutes"), F.sum("timed_calls"), 12, 2).alias("avg_call_duration"),
            some(F.sum("dropped")).alias("dropped_calls"),
            some(F.sum("roaming")).alias("roaming_calls"),
            some(F.sum("calls_5g")).alias("calls_5g"),
            some(F.sum("calls_4g")).alias("calls_4g"),
        )
    )
    return days.orderBy("call_date") if ordered else days


def gold_kpis(arpu: DataFrame) -> DataFrame:
    """One row of headline figures over the monthly ARPU table."""
    return arpu.agg(
        F.count_distinct("customer_id").alias("total_customers"),
        X.mean_round("total_revenue_qar", 20, 2).alias("avg_arpu_qar"),
        X.rounded(F.sum("total_revenue_qar"), 24, 2).alias("total_revenue_qar"),
        X.mean_round("call_drop_rate_pct", 9, 2).alias("avg_drop_rate_pct"),
        X.mean_round("data_usage_gb", 20, 3).alias("avg_data_gb_per_customer"),
        F.sum("is_churning_signal").alias("churn_risk_customers"),
    )


def churn_features(
    customers: DataFrame, usage: DataFrame, recharges: DataFrame, fanout: bool = False
) -> DataFrame:
    """Label and 19 features per customer; customers without activity get zeros."""
    facts = customer_facts(customers.select(*FEATURE_PROFILE), usage, recharges)
    return facts_features(_multiplied(facts) if fanout else facts, fanout)


def facts_features(facts: DataFrame, fanout: bool = False) -> DataFrame:
    """Label and features from rows of :func:`customer_facts`."""
    rows = F.col("recharge_rows_seen" if fanout else "recharge_rows")

    def count0(c):
        return F.coalesce(c, F.lit(0)).cast("bigint")

    def double0(c):
        return F.coalesce(c.cast("double"), F.lit(0.0))

    return facts.select(
        "customer_id",
        flag(F.col("churn_risk") == "High").alias("label"),
        "tenure_months",
        "monthly_fee_qar",
        "data_allowance_gb",
        flag(F.col("plan_type") == "PREPAID").alias("is_prepaid"),
        segment_code("segment").alias("segment_encoded"),
        count0("cdr_ids").alias("total_calls"),
        F.coalesce(F.col("revenue").cast("decimal(24,3)"), F.lit(0).cast("decimal(24,3)")).alias(
            "total_cdr_revenue"
        ),
        double0(X.ratio("minutes", "timed_calls")).alias("avg_call_duration"),
        double0(X.ratio("mb", F.lit(1024))).alias("total_data_gb"),
        count0("dropped").alias("dropped_calls"),
        double0(X.ratio(F.col("dropped") * 100, "cdr_ids")).alias("drop_rate_pct"),
        count0("days").alias("active_days"),
        count0("roaming").alias("roaming_calls"),
        count0("calls_5g").alias("calls_5g"),
        double0(X.ratio("peak", "calls")).alias("peak_hour_ratio"),
        count0("recharge_ids").alias("total_recharges"),
        F.coalesce(F.col("recharged").cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)")).alias(
            "total_recharge_amount"
        ),
        double0(X.ratio("recharged", rows)).alias("avg_recharge_amount"),
        count0("digital").alias("digital_recharges"),
    )


def label_balance(features: DataFrame) -> DataFrame:
    return features.groupBy("label").agg(F.count("*").alias("customers"))


def band_counts(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("churn_score_band")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "churn_score_band")
    )
