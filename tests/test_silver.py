import datetime as dt
from decimal import Decimal

import frames

from cdrlake.operators import dedup, filters, silver


def test_cdr_is_typed_standardised_and_flagged(spark):
    row = silver.silver_cdr(frames.cdr(spark, {})).first()
    assert (row.call_type, row.network_type, row.termination_code) == ("VOICE", "5G", "USER_DROPPED")
    assert (row.region, row.segment, row.roaming_country) == ("Doha", "VIP", "DOMESTIC")
    assert (row.revenue_qar, row.data_consumed_mb) == (Decimal("1.500"), Decimal("0.00"))
    assert row.duration_minutes == Decimal("1.50")
    assert (row.is_dropped, row.is_successful, row.is_voice, row.is_data_session, row.is_international) == (1, 0, 1, 0, 0)
    assert (row.time_of_day, row.is_peak_hour, row.call_month, row.call_week) == ("Morning", 1, "2024-10", "2024-40")
    assert row.call_start_dttm == dt.datetime(2024, 10, 1, 8, 0)


def test_cdr_bad_rows_go_after_duplicates(spark, rows):
    bronze = frames.cdr(
        spark,
        {"cdr_id": "keep"},
        {"cdr_id": "no customer", "customer_id": None},
        {"cdr_id": "bad date", "call_date": "2024-13-45"},
        {"cdr_id": "negative", "revenue_qar": -1.0},
        {"cdr_id": "no revenue", "revenue_qar": None},
        {"cdr_id": "no start", "call_start_dttm": "x"},
        # The first copy is bad, so the id is lost altogether.
        {"cdr_id": "shadowed", "call_start_dttm": "2024-10-01 07:00:00", "revenue_qar": -1.0},
        {"cdr_id": "shadowed", "call_start_dttm": "2024-10-01 09:00:00"},
        {"cdr_id": None, "duration_seconds": 1},
        {"cdr_id": None, "duration_seconds": 2},
    )
    got = silver.silver_cdr(bronze)
    assert rows(got, "cdr_id") == sorted([("keep",), ("no revenue",), ("no start",), (None,)], key=repr)


def test_dedup_keeps_the_first_by_start_and_is_deterministic(spark, rows):
    copies = [
        {"call_start_dttm": f"2024-10-01 {h:02d}:00:00", "duration_seconds": h, "call_hour": h} for h in range(8, 20)
    ]
    copies.append({"call_start_dttm": None, "duration_seconds": 1})
    bronze = frames.cdr(spark, *copies)
    for parts in (1, 3, 5):
        got = silver.unique_cdr(bronze.repartition(parts))
        assert rows(got, "duration_seconds") == [(8,)]


def test_dedup_limits_before_the_shuffle(spark):
    plan = silver.unique_cdr(frames.cdr(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_customers(spark, rows):
    bronze = frames.customers(
        spark,
        {"segment": "Mid Value", "updated_at": "2024-01-01 00:00:00"},
        {"segment": "High Value", "updated_at": "2024-02-01 00:00:00"},
        {"customer_id": "B", "is_active": 0},
        {"customer_id": "C", "msisdn": None, "monthly_fee_qar": None, "activation_date": "31/12/2024", "plan_type": "Postpaid"},
    )
    got = silver.silver_customers(bronze)
    assert "msisdn" not in got.columns
    assert "msisdn" in silver.silver_customers(bronze, drop_raw=False).columns
    columns = ["customer_id", "segment", "is_high_value", "is_postpaid", "msisdn_masked", "monthly_fee_qar", "activation_date"]
    assert rows(got, *columns) == [
        ("A", "High Value", 1, 0, "+974300****", Decimal("10.00"), dt.date(2024, 1, 1)),
        ("C", "VIP", 1, 1, None, Decimal("0.00"), None),
    ]


def test_recharges(spark, rows):
    bronze = frames.recharges(
        spark,
        {},
        {"recharge_dttm": "2024-10-02 11:00:00", "recharge_amount": 99.0},
        {"recharge_id": "R2", "recharge_amount": 0.0},
        {"recharge_id": "R3", "recharge_amount": -5.0},
        {"recharge_id": "R4", "recharge_amount": None},
        {"recharge_id": "R5", "customer_id": None},
        {"recharge_id": "R6", "recharge_amount": 25.01, "recharge_channel": "USSD"},
    )
    got = rows(silver.silver_recharges(bronze), "recharge_id", "recharge_amount", "is_digital_channel", "amount_band")
    assert got == [("R1", Decimal("20.00"), 1, "Low (≤25)"), ("R6", Decimal("25.01"), 0, "Mid (26-75)")]


def test_audit_columns(spark):
    row = silver.with_audit(frames.cdr(spark, {}), "CDR_BATCH").first()
    assert row.source_system == "CDR_BATCH" and row.silver_load_dttm is not None


def test_filters(spark, rows):
    df = frames.cdr(spark, *[{"cdr_id": d, "call_date": d} for d in ("2024-10-01", "2024-10-15", "2024-11-01")])
    window = filters.in_window(df, "call_date", "2024-10-01", "2024-10-15")
    assert rows(window, "cdr_id") == [("2024-10-01",), ("2024-10-15",)]
    assert filters.slice_by(df, call_date=["2024-11-01"], region=" Doha ", segment=None).count() == 1
    assert filters.slice_by(df).count() == 3
    grants = spark.createDataFrame([("doha", " Doha "), ("other", "x")], "role string, region string")
    assert filters.rls(df, grants, "doha").count() == 3
    assert filters.rls(df, grants, "other").count() == 0
    assert dedup.distinct_values(df, "region").count() == 1


def test_amounts_that_do_not_fit_are_rejected_not_zero(spark, rows):
    bronze = frames.cdr(
        spark, {"cdr_id": "1", "revenue_qar": 12_345_678.9}, {"cdr_id": "1", "revenue_qar": 2.0}, {"cdr_id": "2", "data_consumed_mb": 1e12},
        {"cdr_id": "3", "revenue_qar": None}, {"cdr_id": "4", "customer_id": None}, {"cdr_id": "5", "revenue_qar": -1.0}, {"cdr_id": "6", "call_date": "x"},
    )
    good = silver.silver_cdr(bronze)
    assert [(r.cdr_id, float(r.revenue_qar)) for r in good.orderBy("cdr_id").collect()] == [("1", 2.0), ("3", 0.0)]
    assert rows(silver.reject_counts(cdrs=silver.checked_cdr(bronze)), "reject_reason", "rejected") == [
        ("misfit data_consumed_mb", 1), ("misfit revenue_qar", 1), ("negative revenue_qar", 1), ("no call_date", 1), ("no customer_id", 1),
    ]
    customers = frames.customers(spark, {}, {"customer_id": "B", "monthly_fee_qar": 1e12})
    assert rows(silver.silver_customers(customers), "customer_id") == [("A",)]
    assert rows(silver.reject_counts(customers=silver.checked_customers(customers)), "reject_reason") == [("misfit monthly_fee_qar",)]
    recharges = frames.recharges(spark, {}, {"recharge_id": "x", "recharge_amount": 1e12})
    assert rows(silver.reject_counts(recharges=silver.checked_recharges(recharges)), "reject_reason") == [("misfit recharge_amount",)]


def test_unused_columns_are_not_shuffled(spark):
    plan = silver.unique_cdr(frames.cdr(spark, {})).groupBy("call_type").count()._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line or "Exchange hashpartitioning" in line]
    assert sorts and not any("tower" in line or "created_at" in line or "plan_name" in line for line in sorts)
