"""Report measures and the queries behind the report visuals."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact as X
from ..functions.codes import SEGMENTS

#: Column of segments that are not listed, and of none.
OTHER = "Other"


def _high_risk() -> Column:
    return F.col("churn_score_band") == "High Risk"


def _grouped(df: DataFrame, by):
    return df.groupBy(*([by] if isinstance(by, str) else list(by or [])))


def arpu(c360: DataFrame, by=None) -> DataFrame:
    return _grouped(c360, by).agg(X.mean("avg_monthly_arpu").alias("arpu"))


def revenue_mom(trend: DataFrame, by=None) -> DataFrame:
    """Revenue per month, of the month before, and the growth in percent.

    Each month's revenue is sent to its own month and, as the previous value, to
    the next one; the months then meet in one aggregation.  A gap in the months
    gives no previous value, and no growth.
    """
    keys = [by] if isinstance(by, str) else list(by or [])
    monthly = trend.groupBy("call_month", *keys).agg(X.total("total_revenue", 24, 2).alias("revenue"))
    month_start = F.to_date(F.concat("call_month", F.lit("-01")))
    following = F.date_format(F.add_months(month_start, 1), "yyyy-MM")
    none = F.lit(None).cast("decimal(24,2)")
    roles = F.array(
        F.struct(F.col("call_month").alias("m"), F.col("revenue").alias("now"), none.alias("before")),
        F.struct(following.alias("m"), none.alias("now"), F.col("revenue").alias("before")),
    )
    both = monthly.select(*keys, F.inline(roles))
    now, before = F.col("revenue"), F.col("previous_revenue")
    return (
        both.groupBy(F.col("m").alias("call_month"), *keys)
        .agg(F.max("now").alias("revenue"), F.max("before").alias("previous_revenue"))
        .where(now.isNotNull())
        .withColumn("mom_pct", X.ratio(now - before, before) * 100)
    )


def high_value_share(c360: DataFrame) -> DataFrame:
    high = F.sum(F.when(F.col("is_high_value") == 1, F.col("total_cdr_revenue")))
    return c360.agg((X.ratio(high, F.sum("total_cdr_revenue")) * 100).alias("high_value_pct"))


def high_churn_count(c360: DataFrame) -> DataFrame:
    return c360.agg(F.count(F.when(_high_risk(), F.col("customer_id"))).alias("high_churn_count"))


def revenue_at_risk(c360: DataFrame) -> DataFrame:
    arpu_at_risk = F.when(_high_risk(), F.col("avg_monthly_arpu"))
    return c360.agg(X.total(arpu_at_risk, 24, 2).alias("revenue_at_risk"))


def avg_churn_prob(c360: DataFrame) -> DataFrame:
    return c360.agg(X.mean("churn_probability_pct").alias("avg_churn_prob_pct"))


def kpi_cards(c360: DataFrame, executive: DataFrame) -> DataFrame:
    """The five cards of the first page as (card, value)."""
    money = "decimal(24,2)"
    own = c360.agg(
        F.count("customer_id").cast(money).alias("total_customers"),
        X.mean_round("avg_monthly_arpu", 24, 2).alias("avg_arpu"),
        F.sum("total_cdr_revenue").cast(money).alias("total_revenue"),
    ).unpivot([], ["total_customers", "avg_arpu", "total_revenue"], "card", "value")
    rates = executive.select(
        F.col("churn_risk_pct").cast(money).alias("churn_risk_pct"),
        F.col("avg_drop_rate_pct").cast(money).alias("call_drop_rate_pct"),
    ).unpivot([], ["churn_risk_pct", "call_drop_rate_pct"], "card", "value")
    return own.unionByName(rates)


def revenue_trend(trend: DataFrame, legend: str) -> DataFrame:
    return trend.groupBy("call_month", legend).agg(X.total("total_revenue", 24, 2).alias("total_revenue"))


def _listed(df: DataFrame) -> DataFrame:
    return df.withColumn("segment", F.when(F.col("segment").isin(SEGMENTS), F.col("segment")).otherwise(OTHER))


def revenue_trend_wide(trend: DataFrame) -> DataFrame:
    """One column of revenue per segment; the segments are fixed, so no extra job.

    Revenue of other segments, or of none, stands in the column ``Other``.
    """
    return _listed(trend).groupBy("call_month").pivot("segment", [*SEGMENTS, OTHER]).agg(X.total("total_revenue", 24, 2))


def customers_by(c360: DataFrame, column: str) -> DataFrame:
    return c360.groupBy(column).agg(F.count("*").alias("customers"))


def mean_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean of a decimal column per key, best first."""
    return df.groupBy(key).agg(X.mean(value).alias(name)).orderBy(F.desc(name), key)


def prob_histogram(c360: DataFrame) -> DataFrame:
    """Customers per 20-point bin of the probability; 100 belongs to the last bin."""
    low = F.least(F.floor(F.col("churn_probability_pct") / 20), F.lit(4)) * 20
    return c360.groupBy(low.cast("int").alias("bin_from")).agg(F.count("*").alias("customers"))


def churn_matrix(c360: DataFrame) -> DataFrame:
    """Mean probability by tenure band (rows) and segment (columns), with ``Other`` for the rest."""
    return _listed(c360).groupBy("tenure_band").pivot("segment", [*SEGMENTS, OTHER]).agg(X.mean("churn_probability_pct"))


def top_risk(c360: DataFrame, n: int = 20) -> DataFrame:
    columns = ["customer_id", "churn_probability_pct", "segment", "plan_name", "avg_monthly_arpu"]
    return (
        c360.where(_high_risk())
        .select(*columns)
        .orderBy(F.desc("churn_probability_pct"), "customer_id")
        .limit(n)
    )


def churn_scatter(c360: DataFrame) -> DataFrame:
    return c360.select(
        "customer_id",
        "avg_monthly_arpu",
        "churn_probability_pct",
        F.col("total_cdrs").alias("total_calls"),
        "churn_score_band",
    )


def network_split(daily: DataFrame) -> DataFrame:
    """5G and 4G calls per month and the share of 5G in all calls."""
    total, five = F.sum("total_calls"), F.coalesce(F.sum("calls_5g"), F.lit(0))
    return daily.groupBy("call_month").agg(
        total.alias("total_calls"),
        five.alias("calls_5g"),
        F.coalesce(F.sum("calls_4g"), F.lit(0)).alias("calls_4g"),
        (X.ratio(five, total) * 100).alias("share_5g_pct"),
    )


def daily_combo(daily: DataFrame) -> DataFrame:
    return daily.select("call_date", "total_calls", "daily_revenue")


def calls_by(cdr: DataFrame, column: str) -> DataFrame:
    return cdr.groupBy(column).agg(F.count("*").alias("calls"))


def drop_rate_by_region(regional_performance: DataFrame) -> DataFrame:
    return regional_performance.select("region", "avg_drop_rate").orderBy(F.desc("avg_drop_rate"), "region")


def data_by_network(usage: DataFrame) -> DataFrame:
    return usage.groupBy("call_month", "network_type").agg(
        X.div_round(F.sum("mb"), F.lit(1024), 20, 2).alias("data_gb")
    )


def recharge_frequency(recharge_monthly: DataFrame) -> DataFrame:
    """Top-ups per customer and month: mean and maximum over the customers."""
    return recharge_monthly.groupBy("call_month").agg(
        F.count("customer_id").alias("recharging_customers"),
        F.sum("recharge_count").alias("recharges"),
        X.mean("recharge_count").alias("avg_recharges_per_customer"),
        F.max("recharge_count").alias("max_recharges"),
    )


def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, for previews."""
    return df.limit(n)

