"""Bronze schemas of the four entities and the two control tables.

Dates and timestamps arrive as text and are parsed in Silver.  File readers do
not enforce ``nullable=False``, so every field is declared nullable and the
not-null rules live in the Silver filters.
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def ddl(schema: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


# Column names, types and order of the source files.
CDR = StructType(
    [
        StructField("cdr_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("msisdn", StringType()),
        StructField("call_type", StringType()),
        StructField("call_start_dttm", StringType()),
        StructField("call_end_dttm", StringType()),
        StructField("duration_seconds", IntegerType()),
        StructField("network_type", StringType()),
        StructField("data_consumed_mb", DoubleType()),
        StructField("termination_code", StringType()),
        StructField("is_roaming", IntegerType()),
        StructField("roaming_country", StringType()),
        StructField("revenue_qar", DoubleType()),
        StructField("plan_type", StringType()),
        StructField("plan_name", StringType()),
        StructField("region", StringType()),
        StructField("segment", StringType()),
        StructField("call_date", StringType()),
        StructField("call_hour", IntegerType()),
        StructField("created_at", StringType()),
    ]
)
CUSTOMER = StructType(
    [
        StructField("customer_id", StringType()),
        StructField("msisdn", StringType()),
        StructField("first_name", StringType()),
        StructField("last_name", StringType()),
        StructField("age", IntegerType()),
        StructField("nationality", StringType()),
        StructField("language", StringType()),
        StructField("region", StringType()),
        StructField("device_type", StringType()),
        StructField("plan_type", StringType()),
        StructField("plan_name", StringType()),
        StructField("monthly_fee_qar", DoubleType()),
        StructField("data_allowance_gb", IntegerType()),
        StructField("activation_date", StringType()),
        StructField("tenure_months", IntegerType()),
        StructField("segment", StringType()),
        StructField("churn_risk", StringType()),
        StructField("is_active", IntegerType()),
        StructField("created_at", StringType()),
        StructField("updated_at", StringType()),
    ]
)
RECHARGE = StructType(
    [
        StructField("recharge_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("msisdn", StringType()),
        StructField("recharge_amount", DoubleType()),
        StructField("recharge_channel", StringType()),
        StructField("recharge_dttm", StringType()),
        StructField("validity_days", IntegerType()),
        StructField("expiry_dttm", StringType()),
        StructField("plan_name", StringType()),
        StructField("segment", StringType()),
        StructField("region", StringType()),
        StructField("churn_risk", StringType()),
        StructField("recharge_month", StringType()),
        StructField("recharge_date", StringType()),
        StructField("created_at", StringType()),
    ]
)
EVENT = StructType(
    [
        StructField("event_id", StringType()),
        StructField("event_type", StringType()),
        StructField("customer_id", StringType()),
        StructField("msisdn", StringType()),
        StructField("event_time", StringType()),
        StructField("network_type", StringType()),
        StructField("tower_id", StringType()),
        StructField("region", StringType()),
        StructField("segment", StringType()),
        StructField("plan_name", StringType()),
        StructField("churn_risk", StringType()),
        StructField("duration_seconds", IntegerType()),
        StructField("data_mb", DoubleType()),
        StructField("call_type", StringType()),
        StructField("signal_strength", IntegerType()),
        StructField("recharge_amount", DoubleType()),
        StructField("recharge_channel", StringType()),
        StructField("roaming_country", StringType()),
    ]
)
WATERMARK = StructType(
    [
        StructField("pipeline_name", StringType()),
        StructField("last_watermark", TimestampType()),
        StructField("last_run_status", StringType()),
        StructField("last_run_rows", LongType()),
        StructField("last_run_dttm", TimestampType()),
        StructField("updated_at", TimestampType()),
    ]
)
AUDIT = StructType(
    [
        StructField("audit_id", LongType()),
        StructField("pipeline_name", StringType()),
        StructField("run_id", StringType()),
        StructField("status", StringType()),
        StructField("rows_read", LongType()),
        StructField("rows_written", LongType()),
        StructField("start_dttm", TimestampType()),
        StructField("end_dttm", TimestampType()),
        StructField("error_message", StringType()),
        StructField("created_at", TimestampType()),
    ]
)

# Columns kept by the CSV to Parquet copy of raw CDR files.
CDR_COPY_COLUMNS = [
    "cdr_id",
    "customer_id",
    "msisdn",
    "call_type",
    "call_start_dttm",
    "call_end_dttm",
    "duration_seconds",
    "network_type",
    "data_consumed_mb",
    "termination_code",
    "is_roaming",
    "revenue_qar",
    "call_date",
]
