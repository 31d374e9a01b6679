"""Data-quality reports and post-load validation.  Each report is one pass."""

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import exact as X

# Columns that must be filled in a CDR.
CDR_MANDATORY = ["cdr_id", "customer_id", "call_type", "call_start_dttm", "call_date"]


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, null_count, status) with status ``OK`` or ``<n> nulls``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    n = F.col("null_count")
    return counts.unpivot([], columns, "column", "null_count").withColumn(
        "status", F.when(n == 0, "OK").otherwise(F.concat(n.cast("string"), F.lit(" nulls")))
    )


def negative_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column) < 0).alias("negative_rows"))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; NULL counts as one key value."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        rows.alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        (rows - F.count("*")).alias("duplicate_rows"),
    )


def load_report(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows read, kept and dropped; dropped includes duplicates."""
    marks = [
        raw.select(F.lit(1).alias("r"), F.lit(0).alias("s")),
        silver.select(F.lit(0).alias("r"), F.lit(1).alias("s")),
    ]
    counts = reduce(DataFrame.unionByName, marks).agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("silver_rows"),
    )
    return counts.withColumn("dropped_rows", F.col("raw_rows") - F.col("silver_rows"))


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they pass to the next action, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def observe_quality(df: DataFrame, name: str, columns: list[str]) -> tuple[DataFrame, Observation]:
    """Row count and null counts of the columns, taken while the frame is written."""
    seen = Observation(name)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), seen


def validate_cdr(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("call_type")
        .agg(
            F.count("*").alias("cdr_count"),
            X.total("revenue_qar", 24, 3).alias("total_revenue"),
            X.mean("duration_minutes").alias("avg_duration_min"),
        )
        .orderBy(F.desc("cdr_count"), "call_type")
    )


def validate_cdr_totals(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        F.min("call_date").alias("first_date"),
        F.max("call_date").alias("last_date"),
        X.total("revenue_qar", 24, 3).alias("total_revenue"),
    )


def validate_customers(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("segment", "plan_type")
        .agg(F.count("*").alias("customers"), X.mean("monthly_fee_qar").alias("avg_fee"))
        .orderBy("segment", "plan_type")
    )


def validate_recharges(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("recharge_channel")
        .agg(F.count("*").alias("recharges"), X.total("recharge_amount", 24, 2).alias("total_amount"))
        .orderBy(F.desc("total_amount"), "recharge_channel")
    )


def validate_staging(staging: DataFrame) -> DataFrame:
    """Customers and mean fee per plan type, plus one row ``ALL`` with the total."""
    fee = [F.count("*").alias("cnt"), X.mean("monthly_fee_qar").alias("avg_fee")]
    by_plan = staging.groupBy("plan_type").agg(*fee)
    return by_plan.unionByName(staging.agg(F.lit("ALL").alias("plan_type"), *fee))


def layer_counts(**tables: DataFrame) -> DataFrame:
    """(tbl, rows) per table, as one UNION ALL."""
    counts = [df.agg(F.lit(name).alias("tbl"), F.count("*").alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
