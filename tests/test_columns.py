import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdrlake.functions import casting as C
from cdrlake.functions import codes as K
from cdrlake.functions import exact as X


def values(spark, kind, inputs, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_timestamps_and_dates_give_null_for_bad_text(spark):
    got = values(spark, "string", ["2024-10-01 08:15:30", "2024-10-01", "garbage", None], C.to_ts)
    assert got == [dt.datetime(2024, 10, 1, 8, 15, 30), None, None, None]
    got = values(spark, "string", ["2024-02-29", "2024-13-45", "31/12/2024", None], C.to_d)
    assert got == [dt.date(2024, 2, 29), None, None, None]
    got = values(spark, "string", ["2024-10-01T08:15:30Z", "2024-10-01 08:15:30"], lambda c: C.to_ts(c, C.EVENT_FORMAT))
    assert got == [dt.datetime(2024, 10, 1, 8, 15, 30), None]


def test_money_is_exact_and_null_when_too_large(spark):
    got = values(spark, "double", [0.285, 1.005, 123456789012.0, None], lambda c: C.money(c, 10, 3))
    assert got == [Decimal("0.285"), Decimal("1.005"), None, None]
    assert values(spark, "double", [None], lambda c: C.money_or_zero(c, 10, 3)) == [Decimal("0.000")]


def test_minutes(spark):
    got = values(spark, "int", [0, 1, 59, 90, 3601, None], C.minutes)
    assert got == [Decimal("0.00"), Decimal("0.02"), Decimal("0.98"), Decimal("1.50"), Decimal("60.02"), None]


def test_codes_and_labels(spark):
    assert values(spark, "string", ["  data ", "Voice", None], K.std_code) == ["DATA", "VOICE", None]
    assert values(spark, "string", [" Mid Value ", None], K.std_label) == ["Mid Value", None]


@pytest.mark.parametrize(
    "hour,part,peak",
    [(5, "Night", 0), (6, "Morning", 0), (7, "Morning", 0), (8, "Morning", 1), (11, "Morning", 1),
     (12, "Afternoon", 1), (17, "Afternoon", 1), (18, "Evening", 1), (20, "Evening", 1), (21, "Evening", 0),
     (22, "Evening", 0), (23, "Night", 0), (None, "Night", 0)],
)
def test_day_parts(spark, hour, part, peak):
    assert values(spark, "int", [hour], K.time_of_day) == [part]
    assert values(spark, "int", [hour], K.is_peak) == [peak]


def test_calendar_keys(spark):
    days = [dt.date(2024, 12, 29), dt.date(2024, 12, 30), dt.date(2021, 1, 3), dt.date(2024, 3, 5), None]
    assert values(spark, "date", days, K.week_key) == ["2024-52", "2025-01", "2020-53", "2024-10", None]
    assert values(spark, "date", days[:1], K.month_key) == ["2024-12"]


def test_plain_dates_need_no_formatter(spark):
    """Each text was parsed by a formatter, and each month written by one; both give what the formatter gives."""
    days = ["2024-02-29", "2023-02-29", "2024-13-45", "0000-01-01", "0001-01-01", "9999-12-31", "12024-01-05", "2024-1-5",
            " 2024-01-05", "2024-01-05 ", "2024-01-05\n", "2024-01-05x", "2024-01", "+2024-01-05", "", None]
    formatted = lambda kind, fmt: lambda c: F.try_to_timestamp(c, F.lit(fmt)).cast(kind).cast("string")
    assert values(spark, "string", days, lambda c: C.to_d(c).cast("string")) == values(spark, "string", days, formatted("date", C.DATE_FORMAT))
    times = [f"{d} {t}" for d in days[:6] for t in ("00:00:00", "23:59:59", "24:00:00", "12:60:00", "1:02:03", "10:00:00.5", "10:00", "10:00:00Z")]
    assert values(spark, "string", times, lambda c: C.to_ts(c).cast("string")) == values(spark, "string", times, formatted("timestamp", C.TIMESTAMP_FORMAT))
    stored = spark.createDataFrame([("2024-03-05",), ("0999-12-01",), ("12024-01-05",), ("-0001-05-06",), (None,)], "v string").select(F.col("v").cast("date").alias("v"))
    assert stored.where(~K.month_key("v").eqNullSafe(F.date_format("v", "yyyy-MM"))).count() == 0
    plan = stored.select(K.month_key("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "year(" in plan


def test_bands(spark):
    ages = [17, 24, 25, 34, 35, 44, 45, 54, 55, None]
    assert values(spark, "int", ages, K.age_band) == [
        "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55+", "55+",
    ]
    months = [5, 6, 11, 12, 23, 24, 35, 36, None]
    assert values(spark, "int", months, K.tenure_band) == [
        "0-6m", "6-12m", "6-12m", "1-2yr", "1-2yr", "2-3yr", "2-3yr", "3yr+", "3yr+",
    ]
    amounts = [Decimal(a) for a in ("-5", "25", "25.01", "75", "75.01")] + [None]
    low, mid, high = "Low (≤25)", "Mid (26-75)", "High (>75)"
    assert values(spark, "decimal(10,2)", amounts, K.amount_band) == [low, low, mid, mid, high, high]


def test_scores(spark):
    p = [0.70, 0.6999, 0.40, 0.3999, None]
    assert values(spark, "double", p, K.score_band) == [
        "High Risk", "Medium Risk", "Medium Risk", "Low Risk", "Low Risk",
    ]
    assert values(spark, "double", p, K.is_high_score) == [1, 0, 0, 0, 0]


def test_masks_channels_segments(spark):
    assert values(spark, "string", ["+97431234567", None], K.mask_msisdn) == ["+974312****", None]
    assert values(spark, "string", ["IVR", "USSD", None], K.is_digital) == [1, 0, 0]
    names = ["Low Value", "Mid Value", "High Value", "VIP", "other", None]
    assert values(spark, "string", names, K.segment_code) == [0, 1, 2, 3, 3, 3]


def test_rounded_quotients_are_half_up_and_exact(spark):
    df = spark.createDataFrame(
        [(Decimal("0.57"), 2), (Decimal("1.00"), 3), (Decimal("2.01"), 2), (Decimal("1.00"), 0), (None, 2)],
        "n decimal(12,2), d bigint",
    )
    got = [r[0] for r in df.select(X.div_round("n", "d", 12, 2)).collect()]
    assert got == [Decimal("0.29"), Decimal("0.33"), Decimal("1.01"), None, None]


def test_aggregates(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, None)], "k int, v int")
    one = df.agg(
        F.count("*"), F.count("v"), F.count_distinct("k"), X.count_where(F.col("v") == 5),
        X.null_if_zero(X.count_where(F.col("v") == 5)), X.mean("v"), X.ratio(F.sum("v"), F.lit(0)),
    ).first()
    assert tuple(one) == (3, 2, 2, 0, None, 0.5, None)
