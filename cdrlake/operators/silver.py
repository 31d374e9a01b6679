"""Bronze to Silver: typed, standardised, de-duplicated rows.

Order matters: duplicates go before bad rows, so a bad first copy also removes
the later good one.  Derived columns are computed after the shuffle of the
duplicate removal, so that they do not travel.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import casting as C
from ..functions import codes as K
from .dedup import keep_first
from .filters import active, require


def _with(df: DataFrame, **columns) -> DataFrame:
    return df.withColumns(columns)


def _misfit(**kinds) -> Column:
    """``misfit <column>`` for the first column whose value has no place in its type, else NULL."""
    bad = [F.when(F.col(c).isNotNull() & C.money(c, *kind).isNull(), f"misfit {c}") for c, kind in kinds.items()]
    return F.coalesce(*bad, F.lit(None).cast("string"))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reason) of checked rows."""
    reason = F.col("reject_reason")
    return checked.where(reason.isNull()).drop("reject_reason"), checked.where(reason.isNotNull())


def _typed_cdr(bronze: DataFrame) -> DataFrame:
    return _with(
        bronze,
        call_start_dttm=C.to_ts("call_start_dttm"),
        call_end_dttm=C.to_ts("call_end_dttm"),
        call_date=C.to_d("call_date"),
        misfit=_misfit(revenue_qar=(10, 3), data_consumed_mb=(12, 2)),
        revenue_qar=C.money_or_zero("revenue_qar", 10, 3),
        data_consumed_mb=C.money_or_zero("data_consumed_mb", 12, 2),
        call_type=K.std_code("call_type"),
        network_type=K.std_code("network_type"),
        termination_code=K.std_code("termination_code"),
        region=K.std_label("region"),
        segment=K.std_label("segment"),
        roaming_country=F.coalesce("roaming_country", F.lit("DOMESTIC")),
    )


_CDR_ORDER = ["call_start_dttm", "call_end_dttm", "call_date"]


def unique_cdr(bronze: DataFrame) -> DataFrame:
    """Typed and standardised CDRs, one row per id: the first by start time.

    Rows with an amount that does not fit its type are not among them."""
    typed = _typed_cdr(bronze).where(F.col("misfit").isNull()).drop("misfit")
    return keep_first(typed, ["cdr_id"], _CDR_ORDER)


def checked_cdr(bronze: DataFrame) -> DataFrame:
    """All unique CDRs with ``reject_reason``, NULL for those of Silver.

    Misfits are unique among themselves, so a bad amount cannot hide the good row of its id.
    """
    unique = keep_first(_typed_cdr(bronze), ["cdr_id", "misfit"], _CDR_ORDER)
    reason = F.coalesce(
        "misfit",
        F.when(F.col("customer_id").isNull(), "no customer_id"),
        F.when(F.col("call_date").isNull(), "no call_date"),
        F.when(F.col("revenue_qar") < 0, "negative revenue_qar"),
    )
    return unique.withColumn("reject_reason", reason).drop("misfit")


def silver_cdr(bronze: DataFrame) -> DataFrame:
    good = require(unique_cdr(bronze), "customer_id", "call_date").where(F.col("revenue_qar") >= 0)
    return cdr_features(good)


def cdr_features(df: DataFrame) -> DataFrame:
    """Duration, flags, day part and calendar keys of standardised CDR rows."""
    call, end = F.col("call_type"), F.col("termination_code")
    return _with(
        df,
        duration_minutes=C.minutes("duration_seconds"),
        is_dropped=K.flag(end == "USER_DROPPED"),
        is_successful=K.flag(end == "NORMAL"),
        is_data_session=K.flag(call == "DATA"),
        is_voice=K.flag(call.isin(K.VOICE_TYPES)),
        is_international=K.flag(call == "IDD VOICE"),
        time_of_day=K.time_of_day("call_hour"),
        is_peak_hour=K.is_peak("call_hour"),
        call_month=K.month_key("call_date"),
        call_week=K.week_key("call_date"),
    )


def checked_customers(bronze: DataFrame) -> DataFrame:
    """Active customers, one row each (the latest by ``updated_at``), with ``reject_reason``, NULL for those of Silver."""
    labels = ["plan_name", "region", "segment", "churn_risk", "nationality"]
    typed = _with(
        active(bronze),
        activation_date=C.to_d("activation_date"),
        plan_type=K.std_code("plan_type"),
        misfit=_misfit(monthly_fee_qar=(10, 2)),
        monthly_fee_qar=C.money_or_zero("monthly_fee_qar", 10, 2),
        **{name: K.std_label(name) for name in labels},
    )
    unique = keep_first(typed, ["customer_id", "misfit"], [F.col("updated_at").desc_nulls_last()])
    return unique.withColumnRenamed("misfit", "reject_reason")


def silver_customers(bronze: DataFrame, drop_raw: bool = True) -> DataFrame:
    """The good customers; ``drop_raw`` removes the clear ``msisdn`` and keeps only the masked one."""
    return customer_features(split_checked(checked_customers(bronze))[0], drop_raw)


def customer_features(df: DataFrame, drop_raw: bool = True) -> DataFrame:
    out = _with(
        df,
        age_band=K.age_band("age"),
        tenure_band=K.tenure_band("tenure_months"),
        is_high_value=K.flag(F.col("segment").isin(K.HIGH_VALUE_SEGMENTS)),
        is_postpaid=K.flag(F.col("plan_type") == "POSTPAID"),
        msisdn_masked=K.mask_msisdn("msisdn"),
    )
    return out.drop("msisdn") if drop_raw else out


def checked_recharges(bronze: DataFrame) -> DataFrame:
    """All unique recharges with ``reject_reason``, NULL for those of Silver."""
    typed = _with(
        bronze,
        recharge_dttm=C.to_ts("recharge_dttm"),
        expiry_dttm=C.to_ts("expiry_dttm"),
        recharge_date=C.to_d("recharge_date"),
        misfit=_misfit(recharge_amount=(10, 2)),
        recharge_amount=C.money("recharge_amount", 10, 2),
        recharge_channel=K.std_label("recharge_channel"),
        segment=K.std_label("segment"),
    )
    unique = keep_first(typed, ["recharge_id", "misfit"], ["recharge_dttm", "expiry_dttm"])
    reason = F.coalesce(
        "misfit",
        F.when(F.col("customer_id").isNull(), "no customer_id"),
        F.when(F.col("recharge_amount").isNull(), "no recharge_amount"),
        F.when(F.col("recharge_amount") <= 0, "recharge_amount not positive"),
    )
    return unique.withColumn("reject_reason", reason).drop("misfit")


def silver_recharges(bronze: DataFrame) -> DataFrame:
    return recharge_features(split_checked(checked_recharges(bronze))[0])


def recharge_features(df: DataFrame) -> DataFrame:
    return _with(
        df,
        is_digital_channel=K.is_digital("recharge_channel"),
        amount_band=K.amount_band("recharge_amount"),
    )


def reject_counts(**checked: DataFrame) -> DataFrame:
    """Rejected rows per table and reason."""
    out = []
    for name, df in checked.items():
        bad = df.where(F.col("reject_reason").isNotNull()).groupBy("reject_reason").agg(F.count("*").alias("rejected"))
        out.append(bad.select(F.lit(name).alias("entity"), "reject_reason", "rejected"))
    return reduce(DataFrame.unionByName, out)


def with_audit(df: DataFrame, source: str | None, load_column: str = "silver_load_dttm") -> DataFrame:
    return df.select("*", *K.audit(source, load_column))
