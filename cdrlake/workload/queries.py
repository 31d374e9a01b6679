"""Registered queries: name to (Spark query, DuckDB SQL or None)."""

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..config import RunConfig
from ..functions import codes as K
from ..operators import churn, control, dedup, filters, gold, measures, quality, silver, views
from ..plans.batch import run_batch
from ..plans.churn_job import train_and_score
from ..plans.incremental import full_reload_customers, incremental_load
from ..plans.refresh import refresh
from ..plans.serving import register_serving_views
from ..session import scratch_dir, tidy_shuffles
from ..sinks.tables import copy_csv_to_parquet, read_merged, register_catalog, write_csv, write_table
from ..sources import files
from ..sources.tables import fingerprint, read_table
from ..streaming import alerts
from ..streaming import events as ev
from ..streaming.batches import start_event_stream
from ..streaming.progress import ProgressLog, progress_totals
from ..streaming.run import progress_rows, run_streams
from ..streaming.windows import start_window_stream
from . import bronze
from . import oracle as O
from .lake import Lake

Query = Callable[[Lake], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}
WINDOW = ("1996-01-01", "1996-12-31")


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        assert name not in REGISTRY, name
        REGISTRY[name] = (fn, sql)
        return fn

    return add


def add(name: str, sql: str | None, fn: Query) -> None:
    register(name, sql)(fn)


def _text(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, which does not depend on a session zone."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


# --- data quality -----------------------------------------------------------

_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count,"
    f" CASE WHEN COUNT(*) FILTER (WHERE {c} IS NULL) = 0 THEN 'OK'"
    f" ELSE COUNT(*) FILTER (WHERE {c} IS NULL) || ' nulls' END AS status FROM bronze_cdr"
    for c in quality.CDR_MANDATORY
)
add("dq_null_counts", _NULLS, lambda k: quality.null_report(k.bronze_cdr, quality.CDR_MANDATORY))
add(
    "dq_negative_revenue",
    "SELECT COUNT(*) FILTER (WHERE revenue_qar < 0) AS negative_rows FROM bronze_cdr",
    lambda k: quality.negative_count(k.bronze_cdr, "revenue_qar"),
)
add(
    "dq_duplicate_ids",
    "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT cdr_id) AS distinct_keys,"
    " COUNT(*) - COUNT(DISTINCT cdr_id) AS duplicate_rows FROM bronze_cdr",
    lambda k: quality.duplicate_count(k.bronze_cdr, "cdr_id"),
)
add(
    "dq_load_report",
    "SELECT r AS raw_rows, s AS silver_rows, r - s AS dropped_rows"
    " FROM (SELECT (SELECT COUNT(*) FROM bronze_cdr) AS r, (SELECT COUNT(*) FROM silver_cdr) AS s) t",
    lambda k: quality.load_report(k.bronze_cdr, k.cdr),
)
add(
    "validate_cdr_by_type",
    f"SELECT call_type, COUNT(*) AS cdr_count, CAST(SUM(revenue_qar) AS DECIMAL(24,3)) AS total_revenue,"
    f" {O.mean('duration_minutes')} AS avg_duration_min FROM silver_cdr GROUP BY call_type",
    lambda k: quality.validate_cdr(k.cdr),
)
add(
    "validate_cdr_totals",
    "SELECT COUNT(DISTINCT customer_id) AS unique_customers, MIN(call_date) AS first_date,"
    " MAX(call_date) AS last_date, CAST(SUM(revenue_qar) AS DECIMAL(24,3)) AS total_revenue FROM silver_cdr",
    lambda k: quality.validate_cdr_totals(k.cdr),
)
add(
    "validate_customers",
    f"SELECT segment, plan_type, COUNT(*) AS customers, {O.mean('monthly_fee_qar')} AS avg_fee"
    " FROM silver_customers GROUP BY segment, plan_type",
    lambda k: quality.validate_customers(k.customers),
)
add(
    "validate_recharges",
    "SELECT recharge_channel, COUNT(*) AS recharges, CAST(SUM(recharge_amount) AS DECIMAL(24,2)) AS total_amount"
    " FROM silver_recharges GROUP BY recharge_channel",
    lambda k: quality.validate_recharges(k.recharges),
)
_FEE = "CAST(SUM(CAST(monthly_fee_qar AS DECIMAL(10,2))) AS DOUBLE) / NULLIF(COUNT(monthly_fee_qar), 0) AS avg_fee"
add(
    "validate_staging",
    f"SELECT plan_type, COUNT(*) AS cnt, {_FEE} FROM bronze_customers GROUP BY plan_type"
    f" UNION ALL SELECT 'ALL', COUNT(*), {_FEE} FROM bronze_customers",
    lambda k: quality.validate_staging(
        k.bronze_customers.withColumn("monthly_fee_qar", F.col("monthly_fee_qar").try_cast("decimal(10,2)"))
    ),
)
add(
    "layer_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, COUNT(*) AS \"rows\" FROM {t}"
        for t in ("silver_cdr", "silver_customers", "silver_recharges", "arpu_monthly", "customer_summary")
    ),
    lambda k: quality.layer_counts(
        silver_cdr=k.cdr,
        silver_customers=k.customers,
        silver_recharges=k.recharges,
        arpu_monthly=k.arpu,
        customer_summary=k.summary,
    ),
)
add(
    "label_balance",
    "SELECT label, COUNT(*) AS customers FROM churn_features GROUP BY label",
    lambda k: gold.label_balance(k.features),
)

# --- Silver -----------------------------------------------------------------

_CDR_OUT = """cdr_id, s.customer_id, s.msisdn, call_type, call_start_dttm, call_end_dttm, duration_seconds,
  network_type, data_consumed_mb, termination_code, is_roaming, roaming_country, revenue_qar, c.plan_type,
  c.plan_name, trim(c.region) AS region, trim(c.segment) AS segment, call_date, call_hour, s.created_at,
  duration_minutes, is_dropped, is_successful, is_data_session, is_voice, is_international, time_of_day,
  is_peak_hour, call_month, call_week"""
add(
    "silver_cdr",
    f"SELECT {_CDR_OUT} FROM silver_cdr s LEFT JOIN bronze_customers c ON c.customer_id = s.caller_id",
    lambda k: _text(k.cdr, "call_start_dttm", "call_end_dttm"),
)
add(
    "silver_customers",
    "SELECT *, '2024-12-31 00:00:00' AS created_at, '2024-12-31 00:00:00' AS updated_at FROM silver_customers",
    lambda k: k.customers,
)
add(
    "silver_recharges",
    """SELECT recharge_id, s.customer_id, s.msisdn, recharge_amount, recharge_channel, recharge_dttm, validity_days,
  expiry_dttm, plan_name, trim(segment) AS segment, region, churn_risk, recharge_month, recharge_date, s.created_at,
  is_digital_channel, amount_band
FROM silver_recharges s LEFT JOIN bronze_customers c ON c.customer_id = s.buyer_id""",
    lambda k: _text(k.recharges, "recharge_dttm", "expiry_dttm"),
)
_UNIQUE_RECHARGES = """(SELECT * FROM bronze_recharges QUALIFY row_number() OVER (PARTITION BY recharge_id
  ORDER BY recharge_dttm, expiry_dttm, customer_id NULLS LAST, msisdn, recharge_amount NULLS LAST) = 1)"""
add(
    "silver_rejects",
    f"""SELECT 'cdrs' AS entity, CASE WHEN customer_id IS NULL THEN 'no customer_id'
  WHEN call_date IS NULL THEN 'no call_date' ELSE 'negative revenue_qar' END AS reject_reason, COUNT(*) AS rejected
FROM cdr_unique WHERE customer_id IS NULL OR call_date IS NULL OR revenue_qar < 0 GROUP BY 2
UNION ALL SELECT 'recharges', CASE WHEN customer_id IS NULL THEN 'no customer_id'
  WHEN recharge_amount IS NULL THEN 'no recharge_amount' ELSE 'recharge_amount not positive' END, COUNT(*)
FROM {_UNIQUE_RECHARGES} WHERE customer_id IS NULL OR recharge_amount IS NULL OR recharge_amount <= 0 GROUP BY 2""",
    lambda k: silver.reject_counts(
        cdrs=silver.checked_cdr(k.bronze_cdr),
        recharges=silver.checked_recharges(k.bronze_recharges),
        customers=silver.checked_customers(k.bronze_customers),
    ),
)
_FLAGS = ["is_dropped", "is_successful", "is_data_session", "is_voice", "is_international", "is_peak_hour"]
add(
    "silver_cdr_flags",
    "SELECT call_type, termination_code, COUNT(*) AS cdrs, "
    + ", ".join(f"CAST(SUM({f}) AS BIGINT) AS {f}" for f in _FLAGS)
    + " FROM silver_cdr GROUP BY call_type, termination_code",
    lambda k: k.cdr.groupBy("call_type", "termination_code").agg(
        F.count("*").alias("cdrs"), *[F.sum(f).alias(f) for f in _FLAGS]
    ),
)


def _counts(name: str, frame: str, column: str, alias: str, get: Query) -> None:
    add(
        name,
        f"SELECT {column}, COUNT(*) AS {alias} FROM {frame} GROUP BY {column}",
        lambda k: get(k).groupBy(column).agg(F.count("*").alias(alias)),
    )


_counts("calls_by_time_of_day", "silver_cdr", "time_of_day", "calls", lambda k: k.cdr)
_counts("calls_by_week", "silver_cdr", "call_week", "calls", lambda k: k.cdr)
_counts("customers_by_age_band", "silver_customers", "age_band", "customers", lambda k: k.customers)
_counts("customers_by_tenure_band", "silver_customers", "tenure_band", "customers", lambda k: k.customers)
_counts("recharges_by_amount_band", "silver_recharges", "amount_band", "recharges", lambda k: k.recharges)
add(
    "masked_msisdn",
    "SELECT customer_id, msisdn_masked FROM silver_customers",
    lambda k: k.customers.select("customer_id", "msisdn_masked"),
)
add(
    "cdr_window",
    f"SELECT cdr_id, customer_id, call_date, call_hour, revenue_qar FROM bronze_cdr"
    f" WHERE call_date BETWEEN '{WINDOW[0]}' AND '{WINDOW[1]}'",
    lambda k: filters.in_window(k.bronze_cdr, "call_date", *WINDOW).select(
        "cdr_id", "customer_id", "call_date", "call_hour", F.col("revenue_qar").cast("decimal(13,3)")
    ),
)
add(
    "dedup_cdr",
    "SELECT cdr_id, customer_id, call_start_dttm, call_date, network_type, revenue_qar FROM cdr_unique",
    lambda k: _text(
        silver.unique_cdr(k.bronze_cdr).select(
            "cdr_id", "customer_id", "call_start_dttm", "call_date", "network_type", "revenue_qar"
        ),
        "call_start_dttm",
    ),
)
add(
    "distinct_customers",
    "SELECT DISTINCT customer_id FROM silver_cdr",
    lambda k: dedup.distinct_values(k.cdr, "customer_id"),
)

# --- Gold -------------------------------------------------------------------

add("cdr_monthly", "SELECT * FROM cdr_monthly", lambda k: k.cdr_monthly)
add("recharge_monthly", "SELECT * FROM recharge_monthly", lambda k: k.recharge_monthly)
add("arpu_monthly", "SELECT * FROM arpu_monthly", lambda k: k.arpu)
add("customer_summary", "SELECT * FROM customer_summary", lambda k: k.summary)
add(
    "customer_summary_fanout",
    "SELECT * FROM customer_summary_fanout",
    lambda k: gold.customer_summary(k.customers, k.usage, k.recharges, fanout=True),
)
add("regional_kpis", "SELECT * FROM regional_kpis", lambda k: k.regional)
add("daily_trend", "SELECT * FROM daily_trend", lambda k: k.daily)
add(
    "gold_kpis",
    f"SELECT COUNT(DISTINCT customer_id) AS total_customers, {O.mean_round('total_revenue_qar', 2, 2)} AS avg_arpu_qar,"
    f" {O.dec('SUM(total_revenue_qar)', 24, 2)} AS total_revenue_qar,"
    f" {O.mean_round('call_drop_rate_pct', 2, 2, 9)} AS avg_drop_rate_pct,"
    f" {O.mean_round('data_usage_gb', 3, 3)} AS avg_data_gb_per_customer,"
    " CAST(SUM(is_churning_signal) AS BIGINT) AS churn_risk_customers FROM arpu_monthly",
    lambda k: gold.gold_kpis(k.arpu),
)
add("churn_features", "SELECT * FROM churn_features", lambda k: k.features)
add(
    "churn_features_fanout",
    "SELECT * FROM churn_features_fanout",
    lambda k: gold.churn_features(k.customers, k.usage, k.recharges, fanout=True),
)

# --- serving views ----------------------------------------------------------

add("vw_executive_kpis", "SELECT * FROM vw_executive_kpis", lambda k: views.vw_executive_kpis(k.summary))
add("vw_arpu_monthly_trend", "SELECT * FROM vw_arpu_monthly_trend", lambda k: k.trend)
add("customer_360_core", "SELECT * FROM customer_360_core", lambda k: k.core_360)
add("customer_360_rule", "SELECT * FROM customer_360_rule", lambda k: k.rule_360)
add(
    "vw_regional_performance",
    "SELECT * FROM vw_regional_performance",
    lambda k: views.vw_regional_performance(k.regional),
)
add(
    "regional_performance_weighted",
    f"""SELECT v.*, w.weighted_call_duration, w.weighted_drop_rate, w.weighted_revenue_per_customer
FROM vw_regional_performance v JOIN (SELECT region,
  {O.div('SUM(avg_duration_min * total_calls)', 2, 'SUM(total_calls)', 2, 12)} AS weighted_call_duration,
  {O.div('SUM(call_drop_rate_pct * total_calls)', 2, 'SUM(total_calls)', 2, 9)} AS weighted_drop_rate,
  {O.div('SUM(total_cdr_revenue)', 2, 'SUM(customer_count)', 2)} AS weighted_revenue_per_customer
  FROM regional_kpis GROUP BY region) w ON w.region = v.region""",
    lambda k: views.vw_regional_performance(k.regional, weighted=True),
)
add(
    "churn_analysis_rule",
    f"""SELECT churn_score_band, COUNT(*) AS customer_count,
  {O.div('SUM(churn_probability)', 9, 'COUNT(churn_probability)', 4, 6)} AS avg_churn_prob,
  {O.div('SUM(s.tenure_months)', 0, 'COUNT(s.tenure_months)', 1, 9)} AS avg_tenure_months,
  {O.mean_round('u.monthly_fee_qar', 2, 2)} AS avg_monthly_fee, CAST(SUM(total_calls) AS BIGINT) AS total_calls,
  {O.div('SUM(CAST(drop_rate_pct AS DECIMAL(15,9)))', 9, 'COUNT(drop_rate_pct)', 2, 9)} AS avg_drop_rate,
  CAST(SUM(u.total_recharges) AS BIGINT) AS total_recharges
FROM rule_scores s LEFT JOIN customer_summary u ON u.customer_id = s.customer_id GROUP BY churn_score_band""",
    lambda k: views.vw_churn_analysis(k.stored_rule_scores, k.stored_summary),
)

# --- measures and visuals ---------------------------------------------------

add("m_arpu", f"SELECT {O.mean('avg_monthly_arpu')} AS arpu FROM customer_360_core", lambda k: measures.arpu(k.core_360))


def _mom_sql(by: str = "") -> str:
    key, on = (f"{by}, ", f" AND p.{by} IS NOT DISTINCT FROM c.{by}") if by else ("", "")
    keys = f"c.{by}, " if by else ""
    return f"""SELECT {keys}c.call_month, c.revenue, p.revenue AS previous_revenue,
  CAST(c.revenue - p.revenue AS DOUBLE) / NULLIF(CAST(p.revenue AS DOUBLE), 0) * 100 AS mom_pct
FROM (SELECT {key}call_month, CAST(SUM(total_revenue) AS DECIMAL(24,2)) AS revenue FROM vw_arpu_monthly_trend
  GROUP BY ALL) c
LEFT JOIN (SELECT {key}call_month, CAST(SUM(total_revenue) AS DECIMAL(24,2)) AS revenue FROM vw_arpu_monthly_trend
  GROUP BY ALL) p ON CAST(p.call_month || '-01' AS DATE) + INTERVAL 1 MONTH = CAST(c.call_month || '-01' AS DATE){on}"""


add("m_revenue_mom", _mom_sql(), lambda k: measures.revenue_mom(k.trend))
add("m_revenue_mom_by_segment", _mom_sql("segment"), lambda k: measures.revenue_mom(k.trend, "segment"))
add(
    "m_high_value_share",
    "SELECT CAST(SUM(total_cdr_revenue) FILTER (WHERE is_high_value = 1) AS DOUBLE)"
    " / NULLIF(CAST(SUM(total_cdr_revenue) AS DOUBLE), 0) * 100 AS high_value_pct FROM customer_360_core",
    lambda k: measures.high_value_share(k.core_360),
)
add(
    "m_high_churn_count_rule",
    "SELECT COUNT(*) FILTER (WHERE churn_score_band = 'High Risk') AS high_churn_count FROM customer_360_rule",
    lambda k: measures.high_churn_count(k.rule_360),
)
add(
    "m_revenue_at_risk_rule",
    "SELECT CAST(SUM(avg_monthly_arpu) FILTER (WHERE churn_score_band = 'High Risk') AS DECIMAL(24,2))"
    " AS revenue_at_risk FROM customer_360_rule",
    lambda k: measures.revenue_at_risk(k.rule_360),
)
add(
    "m_avg_churn_prob_rule",
    f"SELECT {O.mean('churn_probability_pct')} AS avg_churn_prob_pct FROM customer_360_rule",
    lambda k: measures.avg_churn_prob(k.rule_360),
)
add(
    "viz_kpi_cards",
    f"""SELECT 'total_customers' AS card, CAST(COUNT(customer_id) AS DECIMAL(24,2)) AS "value" FROM customer_360_core
UNION ALL SELECT 'avg_arpu', CAST({O.mean_round('avg_monthly_arpu', 2, 2)} AS DECIMAL(24,2)) FROM customer_360_core
UNION ALL SELECT 'total_revenue', CAST(SUM(total_cdr_revenue) AS DECIMAL(24,2)) FROM customer_360_core
UNION ALL SELECT 'churn_risk_pct', CAST(churn_risk_pct AS DECIMAL(24,2)) FROM vw_executive_kpis
UNION ALL SELECT 'call_drop_rate_pct', CAST(avg_drop_rate_pct AS DECIMAL(24,2)) FROM vw_executive_kpis""",
    lambda k: measures.kpi_cards(views.customer_360_core(k.stored_summary), views.vw_executive_kpis(k.stored_summary)),
)
for _legend, _name in (("segment", "viz_revenue_by_segment"), ("plan_type", "viz_revenue_by_plan")):
    add(
        _name,
        f"SELECT call_month, {_legend}, CAST(SUM(total_revenue) AS DECIMAL(24,2)) AS total_revenue"
        f" FROM vw_arpu_monthly_trend GROUP BY call_month, {_legend}",
        lambda k, legend=_legend: measures.revenue_trend(k.trend, legend),
    )
_SEGMENTS = ["Low Value", "Mid Value", "High Value", "VIP"]
_SEGMENT_IS = {s: f"segment = '{s}'" for s in _SEGMENTS} | {
    "Other": "segment IS NULL OR segment NOT IN (" + ", ".join(f"'{s}'" for s in _SEGMENTS) + ")"
}
add(
    "viz_revenue_by_segment_wide",
    "SELECT call_month, "
    + ", ".join(
        f"CAST(SUM(total_revenue) FILTER (WHERE {cond}) AS DECIMAL(24,2)) AS \"{s}\"" for s, cond in _SEGMENT_IS.items()
    )
    + " FROM vw_arpu_monthly_trend GROUP BY call_month",
    lambda k: measures.revenue_trend_wide(k.trend),
)
add(
    "viz_customers_by_segment",
    "SELECT segment, COUNT(*) AS customers FROM customer_360_core GROUP BY segment",
    lambda k: measures.customers_by(k.core_360, "segment"),
)
_counts("viz_churn_distribution_rule", "rule_scores", "churn_score_band", "customers", lambda k: k.rule_scores)
for _name, _key, _value, _alias in (
    ("viz_arpu_by_segment", "segment", "avg_monthly_arpu", "avg_arpu"),
    ("viz_data_by_segment", "segment", "total_data_gb", "avg_data_gb"),
    ("viz_duration_by_plan", "plan_type", "avg_call_duration_min", "avg_call_duration_min"),
):
    add(
        _name,
        f"SELECT {_key}, {O.mean(_value)} AS {_alias} FROM customer_360_core GROUP BY {_key}",
        lambda k, key=_key, value=_value, alias=_alias: measures.mean_by(k.core_360, key, value, alias),
    )
add(
    "viz_arpu_by_region",
    f"SELECT region, {O.mean('avg_revenue_per_customer')} AS avg_revenue FROM vw_regional_performance GROUP BY region",
    lambda k: measures.mean_by(
        views.vw_regional_performance(k.regional), "region", "avg_revenue_per_customer", "avg_revenue"
    ),
)
add(
    "viz_prob_histogram_rule",
    "SELECT CAST(LEAST(FLOOR(churn_probability_pct / 20), 4) * 20 AS INTEGER) AS bin_from, COUNT(*) AS customers"
    " FROM customer_360_rule GROUP BY 1",
    lambda k: measures.prob_histogram(k.rule_360),
)
add(
    "viz_churn_matrix_rule",
    "SELECT tenure_band, "
    + ", ".join(
        f"CAST(SUM(churn_probability_pct) FILTER (WHERE {cond}) AS DOUBLE)"
        f" / NULLIF(COUNT(churn_probability_pct) FILTER (WHERE {cond}), 0) AS \"{s}\""
        for s, cond in _SEGMENT_IS.items()
    )
    + " FROM customer_360_rule GROUP BY tenure_band",
    lambda k: measures.churn_matrix(k.rule_360),
)
add(
    "viz_top_risk_rule",
    "SELECT customer_id, churn_probability_pct, segment, plan_name, avg_monthly_arpu FROM customer_360_rule"
    " WHERE churn_score_band = 'High Risk' ORDER BY churn_probability_pct DESC, customer_id LIMIT 20",
    lambda k: measures.top_risk(k.rule_360),
)
add(
    "viz_churn_scatter_rule",
    "SELECT customer_id, avg_monthly_arpu, churn_probability_pct, total_cdrs AS total_calls, churn_score_band"
    " FROM customer_360_rule",
    lambda k: measures.churn_scatter(k.rule_360),
)
add(
    "viz_5g_share",
    """SELECT call_month, CAST(SUM(total_calls) AS BIGINT) AS total_calls,
  CAST(COALESCE(SUM(calls_5g), 0) AS BIGINT) AS calls_5g, CAST(COALESCE(SUM(calls_4g), 0) AS BIGINT) AS calls_4g,
  CAST(COALESCE(SUM(calls_5g), 0) AS DOUBLE) / NULLIF(SUM(total_calls), 0) * 100 AS share_5g_pct
FROM daily_trend GROUP BY call_month""",
    lambda k: measures.network_split(k.daily),
)
add(
    "viz_daily_combo",
    "SELECT call_date, total_calls, daily_revenue FROM daily_trend",
    lambda k: measures.daily_combo(k.daily),
)
add(
    "viz_calls_by_hour",
    "SELECT call_hour, COUNT(*) AS calls FROM silver_cdr GROUP BY call_hour",
    lambda k: measures.calls_by(k.cdr, "call_hour"),
)
add(
    "viz_drop_rate_by_region",
    "SELECT region, avg_drop_rate FROM vw_regional_performance",
    lambda k: measures.drop_rate_by_region(views.vw_regional_performance(k.regional)),
)
add(
    "viz_data_by_network",
    f"SELECT call_month, network_type, {O.div('SUM(data_consumed_mb)', 2, '1024', 2)} AS data_gb"
    " FROM silver_cdr GROUP BY call_month, network_type",
    lambda k: measures.data_by_network(k.usage),
)
add(
    "kpi_recharge_frequency",
    "SELECT call_month, COUNT(customer_id) AS recharging_customers, CAST(SUM(recharge_count) AS BIGINT) AS recharges,"
    " CAST(SUM(recharge_count) AS DOUBLE) / COUNT(recharge_count) AS avg_recharges_per_customer,"
    " MAX(recharge_count) AS max_recharges FROM recharge_monthly GROUP BY call_month",
    lambda k: measures.recharge_frequency(k.recharge_monthly),
)
add(
    "slice_arpu",
    "SELECT * FROM arpu_monthly WHERE call_month = '1997-06' AND segment IN ('VIP', 'High Value')"
    " AND region = 'EUROPE' AND plan_type = 'PREPAID'",
    lambda k: filters.slice_by(
        k.arpu, call_month="1997-06", segment=["VIP", "High Value"], region="EUROPE", plan_type="PREPAID"
    ),
)
add(
    "rls_region",
    "SELECT customer_id, region, segment, avg_monthly_arpu FROM customer_360_core WHERE region IN"
    " (SELECT r_name FROM region WHERE 'RegionalManager_' || r_name = 'RegionalManager_ASIA')",
    lambda k: filters.rls(k.core_360, _grants(k), "RegionalManager_ASIA").select(
        "customer_id", "region", "segment", "avg_monthly_arpu"
    ),
)


def _grants(k: Lake) -> DataFrame:
    return k.table("region").select(
        F.concat(F.lit("RegionalManager_"), "r_name").alias("role"), F.col("r_name").alias("region")
    )


# --- top-k and ranked reads -------------------------------------------------

add(
    "top_arpu_trend",
    "SELECT * FROM vw_arpu_monthly_trend ORDER BY call_month, total_revenue DESC, segment NULLS FIRST,"
    " plan_type NULLS FIRST, region NULLS FIRST LIMIT 10",
    lambda k: measures.top_n(
        k.trend, 10, "call_month", F.desc("total_revenue"), "segment", "plan_type", "region"
    ),
)
add(
    "top_customers_arpu",
    "SELECT * FROM customer_360_rule ORDER BY avg_monthly_arpu DESC NULLS LAST, customer_id LIMIT 20",
    lambda k: measures.top_n(k.rule_360, 20, F.desc_nulls_last("avg_monthly_arpu"), "customer_id"),
)
add(
    "regional_ranked",
    "SELECT * FROM vw_regional_performance",
    lambda k: views.vw_regional_performance(k.regional).orderBy(F.desc("total_revenue"), "region"),
)
add(
    "churn_ranked_rule",
    "SELECT churn_score_band, CAST(SUM(churn_probability) AS DECIMAL(22,9)) AS total_probability FROM rule_scores"
    " GROUP BY churn_score_band",
    lambda k: k.rule_scores.groupBy("churn_score_band")
    .agg(F.sum("churn_probability").cast("decimal(22,9)").alias("total_probability"))
    .orderBy(F.desc("total_probability")),
)

# --- events, batch ----------------------------------------------------------

_EVENT_TIMES = ("event_time", "enqueued_time")
_EVENT_FLAGS = ["is_dropped", "is_recharge", "is_data_event", "is_high_churn_customer"]
add(
    "event_flag_counts",
    "SELECT event_type, COUNT(*) AS events, "
    + ", ".join(f"CAST(SUM({f}) AS BIGINT) AS {f}" for f in _EVENT_FLAGS)
    + " FROM silver_events GROUP BY event_type",
    lambda k: k.events.groupBy("event_type").agg(
        F.count("*").alias("events"), *[F.sum(f).alias(f) for f in _EVENT_FLAGS]
    ),
)
add("silver_events_batch", "SELECT * FROM silver_events", lambda k: _text(k.events, *_EVENT_TIMES))
add(
    "bad_events",
    "SELECT eh_partition, eh_offset, CASE WHEN garbage THEN NULL ELSE event_id END AS event_id FROM raw_events"
    " WHERE garbage OR customer_id IS NULL",
    lambda k: ev.bad_events(k.parsed_events).select("eh_partition", "eh_offset", "event_id"),
)
add(
    "churn_alerts_batch",
    "SELECT * FROM alerts",
    lambda k: _text(alerts.churn_alerts(k.events), *_EVENT_TIMES),
)
add(
    "events_enriched",
    """SELECT e.event_id, e.event_type, e.customer_id, e.event_time, c.segment, c.plan_name, c.churn_risk, c.region
FROM silver_events e LEFT JOIN silver_customers c ON c.customer_id = e.customer_id""",
    lambda k: _text(ev.enrich_events(k.events, k.customers), "event_time").select(
        "event_id", "event_type", "customer_id", "event_time", "segment", "plan_name", "churn_risk", "region"
    ),
)


# --- control tables and incremental loads -------------------------------------

RECHARGES_SINCE = "1998-01-01 00:00:00"
_RECHARGE_FILES = "(SELECT recharge_month, COUNT(*) AS n FROM bronze_recharges GROUP BY recharge_month)"
_CDR_FILES = "(SELECT call_date, COUNT(*) AS n FROM bronze_cdr GROUP BY call_date)"


def _file_listing(k: Lake) -> DataFrame:
    """The daily CDR and monthly recharge files the Bronze rows would arrive in, some
    with dashes in the name, and the rows in each."""
    days = k.bronze_cdr.groupBy("call_date").agg(F.count("*").alias("file_rows"))
    months = k.bronze_recharges.groupBy("recharge_month").agg(F.count("*").alias("file_rows"))
    day_name = F.concat(F.lit("cdrs_"), F.replace("call_date", F.lit("-"), F.lit("_")), F.lit(".csv"))
    month_name = F.concat(F.lit("recharges_"), "recharge_month", F.lit(".csv"))
    return days.select(day_name.alias("path"), "file_rows").unionByName(
        months.select(month_name.alias("path"), "file_rows")
    )


def _loads(k: Lake) -> DataFrame:
    """Per pipeline: the newest file date, and the rows of the files after the initial watermark."""
    start = F.lit(control.EPOCH).cast("timestamp")
    out = []
    for prefix, pipeline in (("cdrs", "cdrs_incremental_load"), ("recharges", "recharges_incremental")):
        new = files.new_files(_file_listing(k), prefix, start)
        out.append(
            new.agg(
                F.lit(pipeline).alias("pipeline_name"),
                F.max("file_date").cast("timestamp").alias("watermark"),
                F.lit("SUCCESS").alias("status"),
                F.sum("file_rows").alias("rows"),
            )
        )
    return out[0].unionByName(out[1])


def _marks(k: Lake, base: str) -> control.ControlTable:
    marks = control.ControlTable(k.spark, f"{base}/control/watermarks")
    marks.init(control.init_watermarks(k.spark))
    return marks


def _moved(k: Lake) -> DataFrame:
    """The stored watermarks after both loads, which are recorded one after the other as by two jobs."""
    marks = _marks(k, scratch_dir(k.spark, "marks"))
    loads = _loads(k)
    for pipeline in ("cdrs_incremental_load", "recharges_incremental"):
        marks.record(loads.where(F.col("pipeline_name") == pipeline))
    return marks.read()


_LOADED = f"""SELECT 'cdrs_incremental_load' AS pipeline_name,
  strftime(MAX(CAST(try_strptime(call_date, '%Y-%m-%d') AS DATE)), '%Y-%m-%d 00:00:00') AS last_watermark,
  CAST(SUM(n) AS BIGINT) AS last_run_rows
FROM {_CDR_FILES} WHERE CAST(try_strptime(call_date, '%Y-%m-%d') AS DATE) > DATE '2000-01-01'
UNION ALL SELECT 'recharges_incremental', strftime(MAX(CAST(recharge_month || '-01' AS DATE)), '%Y-%m-%d 00:00:00'),
  CAST(SUM(n) AS BIGINT) FROM {_RECHARGE_FILES} WHERE CAST(recharge_month || '-01' AS DATE) > DATE '2000-01-01'"""
add(
    "incremental_files",
    f"""SELECT 'cdrs_' || replace(call_date, '-', '_') || '.csv' AS path, n AS file_rows,
  CAST(call_date AS DATE) AS file_date FROM {_CDR_FILES}
WHERE call_date <> '2024-13-45' AND call_date > '2000-01-01'""",
    lambda k: files.new_files(_file_listing(k), "cdrs", F.lit(control.EPOCH).cast("timestamp")),
)
add(
    "watermark_update",
    f"""SELECT pipeline_name, last_watermark, 'SUCCESS' AS last_run_status, last_run_rows FROM ({_LOADED}) t
UNION ALL SELECT 'customers_full_load', '2000-01-01 00:00:00', 'PENDING', 0""",
    lambda k: _text(
        _moved(k).select("pipeline_name", "last_watermark", "last_run_status", "last_run_rows"), "last_watermark"
    ),
)
add(
    "watermark_lookup",
    f"SELECT last_watermark FROM ({_LOADED}) t WHERE pipeline_name = 'cdrs_incremental_load'",
    lambda k: _text(control.get_watermark(_moved(k), "cdrs_incremental_load"), "last_watermark"),
)


def _land_recharges(k: Lake, base: str, where: str = "true") -> None:
    """Monthly CSV folders of the recharges, with underscores in the name, in addition to those there."""
    tag = F.concat(F.lit("recharges_"), F.replace("recharge_month", F.lit("-"), F.lit("_")))
    landing = k.bronze_recharges.where(where).withColumn("file", tag).hint("rebalance", "file")
    landing.write.mode("append").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).option("compression", "gzip").partitionBy("file").csv(f"{base}/bronze/recharges")


def _load_recharges(k: Lake, base: str, marks: control.ControlTable, schema: StructType = schemas.RECHARGE):
    return incremental_load(
        k.spark, f"{base}/bronze/recharges", "recharges", schema, f"{base}/landing/recharges", marks,
        "recharges_incremental", audit_path=f"{base}/control/audit",
    )


_RECHARGE_SUM = "CAST(SUM(CAST(recharge_amount AS DECIMAL(12,2))) AS DECIMAL(24,2)) AS amount"


@register(
    "incremental_recharge_load",
    f"""SELECT CAST(recharge_month || '-01' AS DATE) AS file_date, COUNT(*) AS recharges,
  CAST(SUM(recharge_amount) AS DECIMAL(24,2)) AS amount FROM bronze_recharges
WHERE recharge_month > substr('{RECHARGES_SINCE}', 1, 7) GROUP BY recharge_month""",
)
def _incremental_recharge_load(k: Lake) -> DataFrame:
    """Monthly CSV folders are written, then those after the watermark are loaded."""
    base = scratch_dir(k.spark, "incremental")
    _land_recharges(k, base)
    marks = _marks(k, base)
    marks.move("recharges_incremental", datetime.fromisoformat(RECHARGES_SINCE), "SUCCESS", 0)
    _load_recharges(k, base, marks)
    loaded = k.spark.read.parquet(f"{base}/landing/recharges")
    return loaded.groupBy("file_date").agg(F.count("*").alias("recharges"), F.expr(_RECHARGE_SUM))


_LATE = "CAST(substr(recharge_month, 6, 2) AS INT) % 2 = 1"


@register(
    "incremental_late_files",
    f"""SELECT CASE WHEN {_LATE} THEN 2 ELSE 1 END AS load_no, CAST(COUNT(DISTINCT recharge_month) AS BIGINT) AS months,
  COUNT(*) AS rows_written, CAST(SUM(recharge_amount) AS DECIMAL(24,2)) AS amount
FROM bronze_recharges GROUP BY 1""",
)
def _incremental_late_files(k: Lake) -> DataFrame:
    """Months with even numbers are loaded first; the others arrive late, most of them before the watermark.

    What each load wrote, by its own count and by what lies in its files' folders."""
    base = scratch_dir(k.spark, "late")
    marks, out, seen = _marks(k, base), [], None
    marks.move("recharges_incremental", datetime(1900, 1, 1), "PENDING", 0)
    for number, where in ((1, f"NOT ({_LATE})"), (2, _LATE)):
        _land_recharges(k, base, where)
        written = _load_recharges(k, base, marks).rows_written["recharges_incremental"]
        landed = k.spark.read.parquet(f"{base}/landing/recharges")
        own = landed if seen is None else landed.join(seen, "source_file", "left_anti")
        seen = landed.select("source_file").distinct()
        seen.write.parquet(f"{base}/seen/{number}")
        seen = k.spark.read.parquet(f"{base}/seen/{number}")
        out.append(
            own.agg(
                F.lit(number).alias("load_no"), F.count_distinct("file_date").alias("months"),
                F.lit(written).cast("bigint").alias("rows_written"), F.expr(_RECHARGE_SUM),
            )
        )
        if number == 1:  # the first load's rows as they lie now
            out[0].write.parquet(f"{base}/first")
            out[0] = k.spark.read.parquet(f"{base}/first")
    return out[0].unionByName(out[1])


@register(
    "audit_runs",
    """SELECT 'recharges_incremental' AS pipeline_name, 'SUCCESS' AS status, COUNT(*) AS rows_read, COUNT(*) AS rows_written,
  false AS has_error FROM bronze_recharges
UNION ALL SELECT 'recharges_incremental', 'FAILED', 0, 0, true
UNION ALL SELECT 'customers_full_load', 'SUCCESS', COUNT(*), COUNT(*), false FROM bronze_customers WHERE is_active = 1""",
)
def _audit_runs(k: Lake) -> DataFrame:
    """Audit rows of a load that fails, since its folder does not exist yet, of the same load after the files came, and of an extract."""
    base = scratch_dir(k.spark, "audit")
    marks = _marks(k, base)
    marks.move("recharges_incremental", datetime(1900, 1, 1), "PENDING", 0)
    try:
        _load_recharges(k, base, marks)
    except AnalysisException:
        pass  # the failed run is what the query shows
    _land_recharges(k, base)
    _load_recharges(k, base, marks)
    full_reload_customers(k.bronze_customers, f"{base}/customers", marks, f"{base}/control/audit")
    runs = read_merged(k.spark, f"{base}/control/audit")
    return runs.select("pipeline_name", "status", "rows_read", "rows_written", F.col("error_message").isNotNull().alias("has_error"))


@register("raw_copy", f"SELECT {', '.join(schemas.CDR_COPY_COLUMNS)} FROM bronze_cdr")
def _raw_copy(k: Lake) -> DataFrame:
    """The 13-column copy of raw CDR rows, one folder per date."""
    out = f"{scratch_dir(k.spark, 'copy')}/landing/cdrs"
    copy_csv_to_parquet(k.bronze_cdr, schemas.CDR_COPY_COLUMNS, out)
    kinds = StructType([schemas.CDR[c] for c in schemas.CDR_COPY_COLUMNS])
    rows = k.spark.read.schema(kinds).parquet(out)
    return rows.withColumns(
        {
            "revenue_qar": F.col("revenue_qar").cast("decimal(13,3)"),
            "data_consumed_mb": F.col("data_consumed_mb").cast("decimal(12,2)"),
        }
    )


def _land_bronze(k: Lake) -> RunConfig:
    """Bronze CSV files of the three batch entities under a scratch folder."""
    cfg = RunConfig(scratch_dir(k.spark, "lake"), "1900-01-01", "2099-12-31")
    for name, df in (
        ("cdrs", k.bronze_cdr),
        ("customers", k.bronze_customers),
        ("recharges", k.bronze_recharges),
    ):
        write_csv(df, cfg.bronze(name), compression="gzip")
    return cfg


_RUNS: dict[tuple, str] = {}


def _once(k: Lake, what: str, build: Callable[[Lake], str]) -> str:
    """The folder of a job's output, run once per session and data: other files in the folder are other data."""
    key = (k.spark.sparkContext.applicationId, k.sf_dir, fingerprint(k.spark, k.sf_dir), what)
    if key not in _RUNS:
        _RUNS[key] = build(k)
    return _RUNS[key]


def _batch(k: Lake) -> str:
    with tidy_shuffles(k.spark):
        cfg = _land_bronze(k)
        run_batch(k.spark, cfg)
    return cfg.base


@register("lake_arpu_monthly", "SELECT * FROM arpu_monthly")
def _lake_arpu(k: Lake) -> DataFrame:
    """ARPU read back after a whole run from CSV files over stored Silver and Gold."""
    return read_table(k.spark, _once(k, "batch", _batch), "gold", "arpu_monthly").drop("gold_load_dttm")


@register("lake_executive_kpis", "SELECT * FROM vw_executive_kpis")
def _lake_kpis(k: Lake) -> DataFrame:
    """The serving view by name, over published Gold tables."""
    register_serving_views(k.spark, _once(k, "batch", _batch), with_scores=False)
    return k.spark.sql("SELECT * FROM vw_executive_kpis")


def _cdrs_by_month(k: Lake, where: str) -> DataFrame:
    """CDRs with the name of their month's file; rows without a date come with the first month."""
    month = F.when(F.col("l_partkey") % 53 == 0, "1992-01").otherwise(K.month_key(F.col("l_shipdate").cast("date")))
    tag = F.concat(F.lit("cdrs_"), F.replace(month, F.lit("-"), F.lit("_")))
    # the texts are made after the rows have moved
    lines = bronze.called_lines(k.spark, k.sf_dir).withColumn("file", tag).where(where).hint("rebalance", "file")
    return bronze.cdr_of(lines, "file")


def _monthly_cdrs(k: Lake, base: str, where: str) -> None:
    """Monthly CSV folders of the CDRs."""
    _cdrs_by_month(k, where).write.mode("append").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).option("compression", "gzip").partitionBy("file").csv(f"{base}/bronze/cdrs")


@register("lake_incremental_arpu", "SELECT * FROM arpu_monthly")
def _lake_incremental_arpu(k: Lake) -> DataFrame:
    """ARPU after two rounds of loads and refreshes; in the second one every other month comes late."""
    cfg = RunConfig(scratch_dir(k.spark, "refresh"))
    base, marks = cfg.base, _marks(k, cfg.base)
    for pipeline in ("cdrs_incremental_load", "recharges_incremental"):
        marks.move(pipeline, datetime(1900, 1, 1), "PENDING", 0)
    full_reload_customers(k.bronze_customers, f"{base}/landing/customers", marks)
    late = "CAST(right(file, 2) AS INT) % 2 = 1"
    for cdrs, recharges in ((f"NOT ({late})", f"NOT ({_LATE})"), (late, _LATE)):
        with tidy_shuffles(k.spark):
            _monthly_cdrs(k, base, cdrs)
            _land_recharges(k, base, recharges)
            incremental_load(
                k.spark, f"{base}/bronze/cdrs", "cdrs", schemas.CDR, f"{base}/landing/cdrs", marks, "cdrs_incremental_load"
            )
            _load_recharges(k, base, marks)
            refresh(k.spark, cfg)
    return read_table(k.spark, base, "gold", "arpu_monthly").drop("gold_load_dttm")


@register(
    "catalog_after_change",
    "SELECT region, COUNT(*) AS customers, CAST(SUM(tenure_months) AS BIGINT) AS months,"
    " COUNT(*) FILTER (WHERE segment = 'VIP') AS vips FROM silver_customers GROUP BY region",
)
def _catalog_after_change(k: Lake) -> DataFrame:
    """A registered table by name, after its folder got a column and another partitioning."""
    base = scratch_dir(k.spark, "catalog")
    database = f"cdr_change_{uuid.uuid4().hex}"
    wanted = k.customers.select("customer_id", "region", "segment", "tenure_months")
    for df, by in ((wanted.drop("tenure_months"), None), (wanted, "segment")):
        write_table(df, f"{base}/gold/customers_by_place", by)
        register_catalog(k.spark, database, base, ["customers_by_place"], location=f"{base}/db")
    return k.spark.table(f"{database}.customers_by_place").groupBy("region").agg(
        F.count("*").alias("customers"), F.sum("tenure_months").alias("months"), F.count_if(F.col("segment") == "VIP").alias("vips")
    )


add(
    "staging_reload",
    f"SELECT plan_type, COUNT(*) AS cnt, {_FEE} FROM bronze_customers GROUP BY plan_type"
    f" UNION ALL SELECT 'ALL', COUNT(*), {_FEE} FROM bronze_customers",
    lambda k: _staging_reload(k),
)
add(
    "active_extract",
    "SELECT customer_id, plan_type, monthly_fee_qar, is_active FROM bronze_customers WHERE is_active = 1",
    lambda k: _active_extract(k),
)


def _staging_reload(k: Lake) -> DataFrame:
    base = scratch_dir(k.spark, "staging")
    write_csv(k.bronze_customers, f"{base}/customers")
    write_table(files.load_customers_staging(k.spark, f"{base}/customers"), f"{base}/staging")
    return quality.validate_staging(k.spark.read.parquet(f"{base}/staging"))


def _active_extract(k: Lake) -> DataFrame:
    base = scratch_dir(k.spark, "extract")
    full_reload_customers(k.bronze_customers, f"{base}/customers", _marks(k, base))
    rows = files.read_extract(k.spark, f"{base}/customers")
    return rows.select("customer_id", "plan_type", "monthly_fee_qar", "is_active")


@register(
    "extract_outcomes",
    """SELECT CASE WHEN age IS NULL THEN 'rejected' ELSE 'written' END AS outcome, COUNT(*) AS customers,
  COUNT(*) AS counted, CAST(SUM(monthly_fee_qar) AS DECIMAL(24,2)) AS fees
FROM bronze_customers WHERE is_active = 1 GROUP BY 1""",
)
def _extract_outcomes(k: Lake) -> DataFrame:
    """Good and rejected rows of an extract whose source has words for unknown ages, as counted and as written."""
    base = scratch_dir(k.spark, "outcomes")
    source = k.bronze_customers.withColumn("age", F.coalesce(F.col("age").cast("string"), F.lit("unknown")))
    found = files.extract_active_customers(source, f"{base}/customers")
    out = []
    for outcome in files.OUTCOMES:
        rows = files.read_extract(k.spark, f"{base}/customers", outcome)
        fees = F.sum(F.col("monthly_fee_qar").cast("decimal(12,2)")).cast("decimal(24,2)")
        counts = F.count("*").alias("customers"), F.lit(found[outcome]).cast("bigint").alias("counted"), fees.alias("fees")
        out.append(rows.agg(F.lit(outcome).alias("outcome"), *counts))
    return out[0].unionByName(out[1])


# --- streams ------------------------------------------------------------------


#: messages of a captured file, and files of a micro-batch at most
FILE_MESSAGES, BATCH_FILES = 50_000, 64


def capture_layout(messages: int) -> tuple[int, int]:
    """Number of captured files, and of those of a micro-batch: files keep their size, a small capture is two batches."""
    parts = max(4, -(-messages // FILE_MESSAGES))
    return parts, min(BATCH_FILES, -(-parts // 2))


def _capture(k: Lake, base: str) -> DataFrame:
    """The messages as captured files, and the stream over them."""
    parts, batch = capture_layout(k.table("events").count())
    k.raw_events.repartition(parts, "offset").write.parquet(f"{base}/capture")
    return ev.read_capture(k.spark, f"{base}/capture", max_files=batch)


def _run_streams(k: Lake):
    """Capture the messages to files, then drain them through both queries."""
    base = scratch_dir(k.spark, "stream")
    queries = run_streams(_capture(k, base), base, trigger=None)
    for q in queries:
        q.awaitTermination()
    return base, queries


@register("silver_events_stream", "SELECT * FROM silver_events")
def _silver_events_stream(k: Lake) -> DataFrame:
    base, _ = _run_streams(k)
    out = k.spark.read.parquet(f"{base}/silver/events").drop("silver_load_dttm")
    return _text(out, *_EVENT_TIMES)


@register("churn_alerts_stream", "SELECT * FROM alerts")
def _churn_alerts_stream(k: Lake) -> DataFrame:
    base, _ = _run_streams(k)
    out = k.spark.read.parquet(f"{base}/gold/realtime_alerts").drop("alert_created", "query", "batch_id")
    return _text(out, *_EVENT_TIMES)


@register("stream_progress")
def _stream_progress(k: Lake) -> DataFrame:
    _, queries = _run_streams(k)
    return progress_rows(k.spark, *queries)


def _lookup_stream(k: Lake) -> str:
    """Run the stream with lookup and dead letters over the messages."""
    base = scratch_dir(k.spark, "lookup")
    write_table(k.customers, f"{base}/silver/customers")
    query = start_event_stream(
        _capture(k, base), f"{base}/silver/events", f"{base}/silver/bad_events", f"{base}/checkpoints/events",
        lambda: read_table(k.spark, base, "silver", "customers"), trigger=None,
    )
    query.awaitTermination()
    return base


@register(
    "events_enriched_stream",
    """SELECT e.event_id, e.event_type, e.customer_id, e.event_time, c.segment, c.plan_name, c.churn_risk, c.region
FROM silver_events e LEFT JOIN silver_customers c ON c.customer_id = e.customer_id""",
)
def _events_enriched_stream(k: Lake) -> DataFrame:
    out = k.spark.read.parquet(f"{_lookup_stream(k)}/silver/events")
    return _text(out, "event_time").select(
        "event_id", "event_type", "customer_id", "event_time", "segment", "plan_name", "churn_risk", "region"
    )


@register(
    "bad_events_stream",
    "SELECT eh_partition, eh_offset, CASE WHEN garbage THEN NULL ELSE event_id END AS event_id,"
    " CASE WHEN garbage THEN 'unreadable' ELSE 'no customer_id' END AS reason,"
    " CASE WHEN garbage THEN 'garbage ' || k END AS garbage_body FROM raw_events WHERE garbage OR customer_id IS NULL",
)
def _bad_events_stream(k: Lake) -> DataFrame:
    out = k.spark.read.parquet(f"{_lookup_stream(k)}/silver/bad_events")
    body = F.when(F.col("reason") == "unreadable", F.col("body"))
    return out.select("eh_partition", "eh_offset", "event_id", "reason", body.alias("garbage_body"))


_HOUR = "date_trunc('hour', CAST(event_time AS TIMESTAMP))"


@register(
    "event_windows_stream",
    f"""SELECT strftime({_HOUR}, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime({_HOUR} + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, event_type, COUNT(*) AS events,
  CAST(SUM(is_dropped) AS BIGINT) AS dropped,
  CAST(SUM(CAST(recharge_amount AS DECIMAL(12,2))) AS DECIMAL(24,2)) AS recharged
FROM silver_events GROUP BY {_HOUR}, event_type
HAVING {_HOUR} + INTERVAL 1 HOUR
  <= (SELECT MAX(CAST(event_time AS TIMESTAMP)) FROM silver_events) - INTERVAL 10 MINUTE""",
)
def _event_windows_stream(k: Lake) -> DataFrame:
    """Hourly counts of all complete hours; the messages come in order of time in three runs of the stream, a tenth of them twice."""
    base = scratch_dir(k.spark, "windows")
    raw = k.raw_events
    edges = raw.agg(F.percentile_approx("enqueuedTime", [0.4, 0.7]).alias("q")).first()["q"]
    later, third = (F.col("enqueuedTime") > F.lit(e) for e in edges)
    for part in (~later, later & ~third, third):
        own = raw.where(part)
        own.union(own.where(F.xxhash64("offset") % 10 == 0)).write.mode("append").parquet(f"{base}/capture")
        # all files of a part in one batch, so that none of its messages is late
        capture = ev.read_capture(k.spark, f"{base}/capture", max_files=1_000_000)
        start_window_stream(capture, f"{base}/gold/windows", f"{base}/checkpoints/windows", None).awaitTermination()
    return _text(k.spark.read.parquet(f"{base}/gold/windows"), "window_start", "window_end")


@register(
    "stream_progress_totals",
    "SELECT 'silver_events' AS query, COUNT(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows FROM raw_events"
    " UNION ALL SELECT 'churn_alerts', COUNT(*), 0 FROM raw_events",
)
def _stream_progress_totals(k: Lake) -> DataFrame:
    """What the listener's log has of both streams; its rows add up to the messages."""
    base = scratch_dir(k.spark, "progress")
    log = ProgressLog(k.spark, f"{base}/control/progress")
    queries = run_streams(_capture(k, base), base, trigger=None)
    for q in queries:
        q.awaitTermination()
    log.close(*queries)
    rows = read_merged(k.spark, f"{base}/control/progress").where(F.col("run_id").isin([str(q.runId) for q in queries]))
    return progress_totals(rows)


# --- churn model --------------------------------------------------------------


def _train(k: Lake) -> str:
    base = scratch_dir(k.spark, "churn")
    facts = k.store_facts(f"{base}/work/customer_facts")
    train_and_score(k.spark, gold.facts_features(facts), base)
    return base


def trained(k: Lake) -> str:
    """Folder of the trained model and its scores."""
    return _once(k, "churn", _train)


def _scores(k: Lake) -> DataFrame:
    return read_table(k.spark, trained(k), "gold", "churn_scores")


def _runs(k: Lake) -> DataFrame:
    return read_table(k.spark, trained(k), "gold", "model_runs")


def _summary(k: Lake) -> DataFrame:
    """The summary of the customers that were scored, from the facts stored for the model."""
    return gold.facts_summary(read_table(k.spark, trained(k), "work", "customer_facts"))


def _scored_360(k: Lake) -> DataFrame:
    return views.vw_customer_360(_summary(k), _scores(k))


_SCORE_OUT = churn.SCORE_COLUMNS + ["model_version"]
add("churn_scores", None, lambda k: _scores(k).select(_SCORE_OUT))
add("top_churn_scores", None, lambda k: churn.top_scores(_scores(k).select(_SCORE_OUT)))
add(
    "score_bands",
    None,
    lambda k: _scores(k).groupBy("churn_score_band", "is_high_churn_risk").agg(
        F.count("*").alias("customers"),
        F.min("churn_probability").alias("lowest"),
        F.max("churn_probability").alias("highest"),
    ),
)
add("churn_band_counts", None, lambda k: gold.band_counts(_scores(k)))
add("churn_metrics", None, lambda k: _runs(k).select("train_rows", "test_rows", "auc", "accuracy", "f1_score"))
add(
    "churn_feature_importance",
    None,
    lambda k: _runs(k).select(F.explode("importances").alias("feature", "importance")),
)
add(
    "churn_top_features",
    None,
    lambda k: churn.top_importances(_runs(k)),
)
add(
    "churn_split",
    "SELECT CASE WHEN ('0x' || substr(md5('42:' || customer_id), 1, 8))::BIGINT % 1000 < 800 THEN 'train' ELSE 'test' END AS part,"
    " label, COUNT(*) AS customers FROM churn_features GROUP BY 1, 2",
    lambda k: _split_sizes(k),
)
add(
    "churn_score_checks",
    "SELECT c.\"check\", true AS ok, n AS scored FROM (VALUES ('High Risk'), ('Medium Risk'), ('Low Risk'), ('listed bands'),"
    " ('one score each')) c(\"check\"), (SELECT COUNT(*) AS n FROM churn_features) t",
    lambda k: churn.check_scores(_scores(k), k.features),
)
add(
    "churn_band_totals",
    "SELECT COUNT(*) AS customers, true AS bands_add_up FROM churn_features",
    lambda k: gold.band_counts(_scores(k)).agg(
        F.sum("count").alias("customers"), (F.count("*") == F.count_distinct("churn_score_band")).alias("bands_add_up")
    ),
)
add("vw_customer_360", None, _scored_360)
add("vw_churn_analysis", None, lambda k: views.vw_churn_analysis(_scores(k), _summary(k)))
add("m_high_churn_count", None, lambda k: measures.high_churn_count(_scored_360(k)))
add("m_avg_churn_prob", None, lambda k: measures.avg_churn_prob(_scored_360(k)))
add("sample_scores", None, lambda k: measures.sample_rows(_scores(k).select(_SCORE_OUT), 10))


def _split_sizes(k: Lake) -> DataFrame:
    train, test = churn.split(k.features)
    parts = [df.select(F.lit(name).alias("part"), "label") for name, df in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1]).groupBy("part", "label").agg(F.count("*").alias("customers"))


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, fn=fn: fn(Lake(spark, sf_dir))) for name, (fn, _) in REGISTRY.items()}


def duckdb_sql() -> dict[str, str]:
    return {name: O.sql(sql) for name, (_, sql) in REGISTRY.items() if sql is not None}
