import datetime as dt
from decimal import Decimal

import frames
import pytest
from pyspark.sql import functions as F

from cdrlake.operators import gold, measures, quality, silver, views


@pytest.fixture(scope="module")
def small(spark):
    cdr = silver.silver_cdr(
        frames.cdr(
            spark,
            {"cdr_id": "1", "revenue_qar": 1.0, "termination_code": "NORMAL"},
            {"cdr_id": "2", "revenue_qar": 2.0, "termination_code": "NORMAL", "call_type": "Data", "data_consumed_mb": 512.0},
            {"cdr_id": "3", "customer_id": "B", "call_date": "2024-11-05", "network_type": None, "is_roaming": 1},
            {"cdr_id": "4", "customer_id": "unknown", "call_type": "SMS", "duration_seconds": None},
        )
    )
    customers = silver.silver_customers(
        frames.customers(
            spark, {}, {"customer_id": "B", "segment": "Low Value"}, {"customer_id": "idle", "churn_risk": "Low"}
        )
    )
    recharges = silver.silver_recharges(
        frames.recharges(
            spark, {}, {"recharge_id": "R2", "recharge_amount": 30.0}, {"recharge_id": "R3", "recharge_amount": 40.0}
        )
    )
    return cdr, customers, recharges


def keyed(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_monthly_counts_are_null_when_nothing_matched(small):
    usage = gold.usage_rows(small[0])
    a = keyed(gold.cdr_monthly(usage), "customer_id")[("A",)]
    assert (a.total_calls, a.voice_calls, a.data_sessions, a.sms_count) == (2, 1, 1, None)
    assert (a.dropped_calls, a.roaming_calls, a.network_types_used) == (None, None, 1)
    assert (a.total_duration_min, a.avg_call_duration_min) == (Decimal("3.00"), Decimal("1.50"))
    assert (a.cdr_revenue_qar, a.total_data_mb) == (Decimal("3.000"), Decimal("512.00"))
    assert a.last_call_date == dt.date(2024, 10, 1)
    b = keyed(gold.cdr_monthly(usage), "customer_id")[("B",)]
    assert (b.network_types_used, b.voice_calls, b.dropped_calls) == (0, 1, 1)
    other = keyed(gold.cdr_monthly(usage), "customer_id")[("unknown",)]
    assert (other.total_duration_min, other.avg_call_duration_min, other.sms_count) == (None, None, 1)
    zero = keyed(gold.cdr_monthly(usage, zero_fill=True), "customer_id")[("A",)]
    assert (zero.dropped_calls, zero.sms_count) == (0, 0)


def test_gold_is_the_same_from_rows_and_from_the_stored_rollup(small, rows):
    cdr, customers, recharges = small
    direct, stored = gold.usage_rows(cdr), gold.usage_daily(cdr)
    for build in (
        gold.cdr_monthly,
        gold.daily_trend,
        lambda u: gold.customer_summary(customers, u, recharges),
        lambda u: gold.regional_kpis(customers, u),
        lambda u: gold.churn_features(customers, u, recharges),
    ):
        assert rows(build(direct)) == rows(build(stored))


def test_arpu(small):
    cdr, customers, recharges = small
    arpu = gold.gold_arpu(
        gold.cdr_monthly(gold.usage_rows(cdr)), gold.recharge_monthly(recharges), customers
    )
    got = keyed(arpu, "customer_id")
    a, b, unknown = got[("A",)], got[("B",)], got[("unknown",)]
    assert (a.recharge_count, a.recharge_revenue_qar, a.avg_recharge_amount) == (3, Decimal("90.00"), 30.0)
    assert a.total_revenue_qar == Decimal("103.00")  # 3 of calls, 90 of recharges, 10 of fee
    assert (a.call_drop_rate_pct, a.data_usage_gb, a.is_churning_signal) == (None, Decimal("0.500"), 1)
    assert (b.recharge_count, b.recharge_revenue_qar, b.call_drop_rate_pct) == (0, Decimal("0.00"), Decimal("100.00"))
    assert (unknown.segment, unknown.total_revenue_qar, unknown.is_churning_signal) == (None, Decimal("1.50"), 0)
    kpis = gold.gold_kpis(arpu).first()
    assert (kpis.total_customers, kpis.total_revenue_qar) == (3, Decimal("116.00"))
    assert kpis.avg_drop_rate_pct == Decimal("100.00")  # NULL rates do not count


def test_summary_and_fanout(small):
    cdr, customers, recharges = small
    usage = gold.usage_rows(cdr)
    plain = keyed(gold.customer_summary(customers, usage, recharges), "customer_id")
    fan = keyed(gold.customer_summary(customers, usage, recharges, fanout=True), "customer_id")
    a, fa = plain[("A",)], fan[("A",)]
    assert (a.total_cdrs, a.total_cdr_revenue, a.total_recharge_amount) == (2, Decimal("3.00"), Decimal("90.00"))
    assert a.avg_monthly_arpu == Decimal("41.00")  # (3 + 90 + 3 * 10) / 3
    assert (fa.total_cdrs, fa.total_cdr_revenue, fa.total_recharge_amount) == (6, Decimal("9.00"), Decimal("180.00"))
    assert (fa.active_days, fa.total_recharges, fa.avg_call_duration) == (a.active_days, 3, a.avg_call_duration)
    assert (plain[("B",)], plain[("idle",)]) == (fan[("B",)], fan[("idle",)])
    idle = plain[("idle",)]
    assert (idle.total_cdrs, idle.active_days, idle.total_recharges) == (0, 0, 0)
    assert (idle.total_cdr_revenue, idle.call_drop_rate_pct, idle.avg_monthly_arpu) == (None, None, None)


def test_features(small):
    cdr, customers, recharges = small
    usage = gold.usage_rows(cdr)
    got = keyed(gold.churn_features(customers, usage, recharges), "customer_id")
    assert (got[("A",)].label, got[("A",)].is_prepaid, got[("A",)].segment_encoded) == (1, 1, 3)
    assert got[("A",)].peak_hour_ratio == 1.0 and got[("A",)].digital_recharges == 3
    idle = got[("idle",)]
    assert (idle.label, idle.total_calls, idle.drop_rate_pct, idle.avg_recharge_amount) == (0, 0, 0.0, 0.0)
    fan = keyed(gold.churn_features(customers, usage, recharges, fanout=True), "customer_id")[("A",)]
    assert (fan.total_calls, fan.digital_recharges, fan.total_recharge_amount) == (6, 6, Decimal("180.00"))
    assert (fan.avg_recharge_amount, fan.peak_hour_ratio) == (30.0, 1.0)
    assert {tuple(r) for r in gold.label_balance(gold.churn_features(customers, usage, recharges)).collect()} == {(1, 2), (0, 1)}


def test_regional_daily_views(small):
    cdr, customers, recharges = small
    usage = gold.usage_rows(cdr)
    regional = gold.regional_kpis(customers, usage)
    vip = keyed(regional, "segment")[("VIP",)]
    assert (vip.customer_count, vip.total_calls, vip.revenue_per_customer) == (2, 2, Decimal("1.50"))
    perf = views.vw_regional_performance(regional, weighted=True).first()
    assert (perf.region, perf.total_customers, perf.avg_drop_rate) == ("Doha", 3, Decimal("50.00"))
    assert perf.weighted_drop_rate == Decimal("33.33")
    day = keyed(gold.daily_trend(usage), "call_date")[(dt.date(2024, 10, 1),)]
    assert (day.total_calls, day.active_customers, day.calls_5g, day.calls_4g) == (3, 2, 3, None)
    kpis = views.vw_executive_kpis(gold.customer_summary(customers, usage, recharges)).first()
    assert (kpis.total_customers, kpis.high_churn_customers, kpis.churn_risk_pct) == (3, 2, Decimal("66.67"))


def test_month_over_month_skips_gaps(spark):
    trend = spark.createDataFrame(
        [("2023-12", "a", Decimal(100)), ("2024-01", "a", Decimal(150)), ("2024-03", "a", Decimal(0)), ("2024-04", "a", Decimal(5))],
        "call_month string, segment string, total_revenue decimal(20,2)",
    )
    got = {r.call_month: r.mom_pct for r in measures.revenue_mom(trend).collect()}
    assert got == {"2023-12": None, "2024-01": 50.0, "2024-03": None, "2024-04": None}
    assert measures.revenue_mom(trend, "segment").count() == 4


def test_histogram_edges(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in ("0", "19.9", "20", "79.9", "80", "100")], "churn_probability_pct decimal(5,1)")
    assert {tuple(r) for r in measures.prob_histogram(df).collect()} == {(0, 2), (20, 1), (60, 1), (80, 2)}


def test_quality_reports(spark, rows):
    bronze = frames.cdr(
        spark, {}, {"customer_id": None}, {"cdr_id": None, "revenue_qar": -1.0}, {"cdr_id": None}, {"cdr_id": "C2"}
    )
    nulls = {r["column"]: (r.null_count, r.status) for r in quality.null_report(bronze, quality.CDR_MANDATORY).collect()}
    assert nulls["cdr_id"] == (2, "2 nulls") and nulls["call_date"] == (0, "OK")
    assert quality.negative_count(bronze, "revenue_qar").first()[0] == 1
    assert tuple(quality.duplicate_count(bronze, "cdr_id").first()) == (5, 3, 2)
    assert tuple(quality.load_report(bronze, silver.silver_cdr(bronze)).first()) == (5, 2, 3)
    assert rows(quality.layer_counts(a=bronze, b=bronze.limit(0))) == [("a", 5), ("b", 0)]


def test_arpu_matches_recharges_by_customer_and_month(spark):
    months = [("A", "2024-10"), ("A", "2024-11"), ("A", None), ("B", "2024-10"), (None, "2024-10")]
    people = silver.silver_customers(frames.customers(spark, {"customer_id": "A"}))
    cdr = silver.silver_cdr(frames.cdr(spark, {"cdr_id": "C1"}, {"cdr_id": "C2", "call_date": "2024-12-01"}, {"cdr_id": "C3", "customer_id": "B"}))
    recharged = spark.createDataFrame([(*m, float(i)) for i, m in enumerate(months)], "customer_id string, recharge_month string, n double")
    recharged = recharged.select("customer_id", "recharge_month", F.col("n").cast("decimal(10,2)").alias("recharge_amount"), F.lit(1).alias("is_digital_channel"))
    arpu = gold.gold_arpu(gold.cdr_monthly(gold.usage_rows(cdr)), gold.recharge_monthly(recharged), people)
    got = {(r.customer_id, r.call_month): (r.recharge_count, float(r.recharge_revenue_qar), r.avg_recharge_amount, r.segment) for r in arpu.collect()}
    assert got == {("A", "2024-10"): (1, 0.0, 0.0, "VIP"), ("A", "2024-12"): (0, 0.0, None, "VIP"), ("B", "2024-10"): (1, 3.0, 3.0, None)}
