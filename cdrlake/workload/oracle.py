"""DuckDB SQL for the registered queries, written independently of the library.

Small named relations are chained as CTEs; :func:`sql` prefixes a query with
those it refers to.  Rounded quotients are computed in integers, since dividing
decimals in DuckDB goes through doubles.
"""

import re


def div(num: str, scale_in: int, den: str, scale: int, precision: int = 20) -> str:
    """``num / den`` rounded half up to ``scale``; num has ``scale_in`` decimals, is >= 0."""
    m = max(scale, scale_in)
    unit = {0: "1", 1: "0.1", 2: "0.01", 3: "0.001", 4: "0.0001"}[scale]
    n = f"CAST(CAST({num} AS DECIMAL(26,{scale_in})) * {10**m} AS HUGEINT)"
    d = f"CAST(NULLIF({den}, 0) AS HUGEINT) * {10 ** (m - scale)}"
    q = f"(2 * {n} + {d}) // (2 * {d})"
    return f"CAST(CAST({q} AS DECIMAL(18,0)) * {unit} AS DECIMAL({precision},{scale}))"


def mean_round(col: str, scale_in: int, scale: int, precision: int = 20) -> str:
    return div(f"SUM({col})", scale_in, f"COUNT({col})", scale, precision)


def dec(expr: str, precision: int, scale: int) -> str:
    return f"CAST(ROUND({expr}, {scale}) AS DECIMAL({precision},{scale}))"


def mean(col: str) -> str:
    return f"CAST(SUM({col}) AS DOUBLE) / NULLIF(COUNT({col}), 0)"


def some(condition: str) -> str:
    """Count of matching rows, NULL when there is none."""
    return f"NULLIF(COUNT(*) FILTER (WHERE {condition}), 0)"


def band(col: str, cases, other: str, op: str) -> str:
    whens = " ".join(f"WHEN {col} {op} {limit} THEN '{label}'" for limit, label in cases)
    return f"CASE {whens} ELSE '{other}' END"


def pick(index: str, values: list[str]) -> str:
    return f"(['" + "','".join(values) + f"'])[CAST({index} AS INT) + 1]"


CTE: dict[str, str] = {}

CTE["bronze_customers"] = f"""
SELECT 'CUST' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS customer_id,
  CASE WHEN c_custkey % 31 <> 0 THEN '+9743' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') END AS msisdn,
  c_name AS first_name, c_name AS last_name,
  CASE WHEN c_custkey % 37 <> 0 THEN CAST(16 + (c_custkey * 13) % 52 AS INTEGER) END AS age,
  ' ' || n_name AS nationality,
  {pick('c_custkey % 3', ['Arabic', 'English', 'Hindi'])} AS language,
  r_name || ' ' AS region,
  {pick('c_custkey % 2', ['Smartphone', 'Tablet'])} AS device_type,
  {pick('c_custkey % 2', [' Prepaid', 'Postpaid'])} AS plan_type,
  {pick('c_custkey % 8', [f'Plan {c} ' for c in 'ABCDEFGH'])} AS plan_name,
  CASE WHEN c_custkey % 29 <> 0 THEN CAST(10 + 45 * (c_custkey % 8) AS DOUBLE) END AS monthly_fee_qar,
  CAST(5 * (1 + c_custkey % 8) AS INTEGER) AS data_allowance_gb,
  CASE WHEN c_custkey % 23 <> 0
    THEN CAST(DATE '2024-12-31' - CAST((1 + (c_custkey * 7) % 60) * 30 AS INTEGER) AS VARCHAR)
    ELSE '31/12/2024' END AS activation_date,
  CASE WHEN c_custkey % 41 <> 0 THEN CAST(1 + (c_custkey * 7) % 60 AS INTEGER) END AS tenure_months,
  CASE c_mktsegment WHEN 'BUILDING' THEN ' Low Value' WHEN 'MACHINERY' THEN 'High Value'
    WHEN 'FURNITURE' THEN 'VIP ' ELSE 'Mid Value' END AS segment,
  CASE WHEN c_acctbal < 1000 THEN 'High' WHEN c_acctbal < 4000 THEN ' Medium' ELSE 'Low ' END AS churn_risk,
  CASE WHEN c_custkey % 20 <> 0 THEN 1 ELSE 0 END AS is_active
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

CTE["bronze_cdr"] = f"""
SELECT *,
  CASE WHEN l_partkey % 59 <> 0 THEN strftime(started, '%Y-%m-%d %H:%M:%S') END AS call_start_dttm,
  strftime(started + to_seconds(duration_seconds), '%Y-%m-%d %H:%M:%S') AS call_end_dttm
FROM (SELECT l_partkey,
  'CDR' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber AS cdr_id,
  CASE WHEN l_suppkey % 41 = 0 THEN NULL
    WHEN o_custkey % 17 = 0 THEN 'VISIT' || lpad(CAST(o_custkey AS VARCHAR), 12, '0')
    ELSE 'CUST' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') END AS customer_id,
  'CUST' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS caller_id,
  '+9743' || lpad(CAST(o_custkey % 10000000 AS VARCHAR), 7, '0') AS msisdn,
  {pick('l_linenumber - 1', [' Voice', 'voice ', 'Data', 'DATA', 'SMS', 'Video Call', 'IDD Voice'])} AS call_type,
  l_shipdate + to_seconds((l_partkey % 24) * 3600 + l_suppkey % 3600) AS started,
  CASE WHEN l_linenumber = 5 THEN 0 ELSE CAST(l_quantity * 37 AS INTEGER) END AS duration_seconds,
  {pick('l_suppkey % 5', ['4G', '5G', '3g', ' 2G', 'WiFi Calling'])} AS network_type,
  CASE WHEN l_linenumber IN (3, 4) THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS data_consumed_mb,
  CASE l_returnflag WHEN 'N' THEN 'normal ' WHEN 'A' THEN 'BUSY' ELSE 'User_Dropped' END AS termination_code,
  CASE WHEN CAST(l_discount AS DECIMAL(4,2)) >= 0.09 THEN 1 ELSE 0 END AS is_roaming,
  CASE WHEN CAST(l_discount AS DECIMAL(4,2)) >= 0.09 THEN 'UAE' END AS roaming_country,
  CAST(CASE WHEN CAST(l_tax AS DECIMAL(4,2)) = 0.07 AND l_linenumber = 5 THEN NULL
    WHEN CAST(l_tax AS DECIMAL(4,2)) = 0.08
      THEN -(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount * 10 AS DECIMAL(3,1)))
    ELSE CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount * 10 AS DECIMAL(3,1)) END
    AS DECIMAL(13,3)) AS revenue_qar,
  CASE WHEN l_partkey % 53 = 0 THEN '2024-13-45' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS call_date,
  CASE WHEN l_partkey % 61 <> 0 THEN CAST(l_partkey % 24 AS INTEGER) END AS call_hour,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t"""

CTE["bronze_recharges"] = """
SELECT 'RCH' || lpad(CAST(o_orderkey - CASE WHEN o_orderkey % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR), 12, '0')
    AS recharge_id,
  CASE WHEN o_orderkey % 43 <> 0
    THEN 'CUST' || lpad(CAST(o_custkey - o_custkey % 2 AS VARCHAR), 12, '0') END AS customer_id,
  'CUST' || lpad(CAST(o_custkey - o_custkey % 2 AS VARCHAR), 12, '0') AS buyer_id,
  '+9743' || lpad(CAST((o_custkey - o_custkey % 2) % 10000000 AS VARCHAR), 7, '0') AS msisdn,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN -((o_orderkey * 13 + o_custkey * 7) % 200)
    WHEN o_orderkey % 47 <> 0 THEN (o_orderkey * 13 + o_custkey * 7) % 200 + 0.25 END AS DECIMAL(10,2))
    AS recharge_amount,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Mobile App' WHEN '2' THEN ' USSD' WHEN '3' THEN 'Web Portal'
    WHEN '4' THEN 'Retailer' ELSE 'IVR ' END AS recharge_channel,
  strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS recharge_dttm,
  CAST(7 + o_orderkey % 53 AS INTEGER) AS validity_days,
  strftime(o_orderdate + to_seconds(o_orderkey % 86400 + (7 + o_orderkey % 53) * 86400), '%Y-%m-%d %H:%M:%S')
    AS expiry_dttm,
  strftime(o_orderdate, '%Y-%m') AS recharge_month,
  strftime(o_orderdate, '%Y-%m-%d') AS recharge_date,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at
FROM orders"""

CTE["cdr_unique"] = """
SELECT cdr_id, customer_id, caller_id, msisdn, upper(trim(call_type)) AS call_type, call_start_dttm,
  call_end_dttm, duration_seconds, upper(trim(network_type)) AS network_type,
  CAST(COALESCE(data_consumed_mb, 0) AS DECIMAL(12,2)) AS data_consumed_mb,
  upper(trim(termination_code)) AS termination_code, is_roaming,
  COALESCE(roaming_country, 'DOMESTIC') AS roaming_country,
  CAST(COALESCE(revenue_qar, 0) AS DECIMAL(10,3)) AS revenue_qar,
  CAST(try_strptime(call_date, '%Y-%m-%d') AS DATE) AS call_date, call_hour, created_at
FROM bronze_cdr
QUALIFY row_number() OVER (PARTITION BY cdr_id ORDER BY call_start_dttm NULLS LAST, call_end_dttm NULLS LAST,
  CAST(try_strptime(bronze_cdr.call_date, '%Y-%m-%d') AS DATE) NULLS LAST, bronze_cdr.customer_id NULLS LAST,
  msisdn, upper(trim(bronze_cdr.call_type)), duration_seconds, upper(trim(bronze_cdr.network_type)),
  COALESCE(bronze_cdr.data_consumed_mb, 0), upper(trim(bronze_cdr.termination_code)), is_roaming,
  COALESCE(bronze_cdr.revenue_qar, 0), call_hour NULLS LAST, created_at) = 1"""

CTE["silver_cdr"] = f"""
SELECT *, CAST(ROUND(duration_seconds / 60.0, 2) AS DECIMAL(12,2)) AS duration_minutes,
  CASE WHEN termination_code = 'USER_DROPPED' THEN 1 ELSE 0 END AS is_dropped,
  CASE WHEN termination_code = 'NORMAL' THEN 1 ELSE 0 END AS is_successful,
  CASE WHEN call_type = 'DATA' THEN 1 ELSE 0 END AS is_data_session,
  CASE WHEN call_type IN ('VOICE', 'IDD VOICE', 'VIDEO CALL') THEN 1 ELSE 0 END AS is_voice,
  CASE WHEN call_type = 'IDD VOICE' THEN 1 ELSE 0 END AS is_international,
  CASE WHEN call_hour >= 6 AND call_hour <= 11 THEN 'Morning' WHEN call_hour >= 12 AND call_hour <= 17
    THEN 'Afternoon' WHEN call_hour >= 18 AND call_hour <= 22 THEN 'Evening' ELSE 'Night' END AS time_of_day,
  CASE WHEN call_hour >= 8 AND call_hour <= 20 THEN 1 ELSE 0 END AS is_peak_hour,
  strftime(call_date, '%Y-%m') AS call_month, strftime(call_date, '%G-%V') AS call_week
FROM cdr_unique
WHERE customer_id IS NOT NULL AND call_date IS NOT NULL AND revenue_qar >= 0"""

CTE["silver_customers"] = f"""
SELECT customer_id, first_name, last_name, age, trim(nationality) AS nationality, language,
  trim(region) AS region, device_type, upper(trim(plan_type)) AS plan_type, trim(plan_name) AS plan_name,
  CAST(COALESCE(monthly_fee_qar, 0) AS DECIMAL(10,2)) AS monthly_fee_qar, data_allowance_gb,
  CAST(try_strptime(activation_date, '%Y-%m-%d') AS DATE) AS activation_date, tenure_months,
  trim(segment) AS segment, trim(churn_risk) AS churn_risk, is_active,
  {band('age', [(25, '18-24'), (35, '25-34'), (45, '35-44'), (55, '45-54')], '55+', '<')} AS age_band,
  {band('tenure_months', [(6, '0-6m'), (12, '6-12m'), (24, '1-2yr'), (36, '2-3yr')], '3yr+', '<')} AS tenure_band,
  CASE WHEN trim(segment) IN ('High Value', 'VIP') THEN 1 ELSE 0 END AS is_high_value,
  CASE WHEN upper(trim(plan_type)) = 'POSTPAID' THEN 1 ELSE 0 END AS is_postpaid,
  CASE WHEN msisdn IS NOT NULL THEN substr(msisdn, 1, 7) || '****' END AS msisdn_masked
FROM bronze_customers WHERE is_active = 1"""

CTE["silver_recharges"] = f"""
SELECT *, {band('recharge_amount', [(25, 'Low (≤25)'), (75, 'Mid (26-75)')], 'High (>75)', '<=')} AS amount_band,
  CASE WHEN recharge_channel IN ('Mobile App', 'Web Portal', 'IVR') THEN 1 ELSE 0 END AS is_digital_channel
FROM (SELECT recharge_id, customer_id, buyer_id, msisdn, recharge_amount, trim(recharge_channel) AS recharge_channel,
    recharge_dttm, validity_days, expiry_dttm, recharge_month, CAST(recharge_date AS DATE) AS recharge_date, created_at
  FROM bronze_recharges
  QUALIFY row_number() OVER (PARTITION BY recharge_id ORDER BY recharge_dttm, expiry_dttm, customer_id NULLS LAST,
    msisdn, recharge_amount NULLS LAST) = 1) t
WHERE customer_id IS NOT NULL AND recharge_amount > 0"""

CTE["cdr_monthly"] = f"""
SELECT customer_id, call_month, COUNT(*) AS total_calls,
  COUNT(*) FILTER (WHERE is_voice = 1) AS voice_calls,
  {some('is_data_session = 1')} AS data_sessions, {some("call_type = 'SMS'")} AS sms_count,
  {some('is_dropped = 1')} AS dropped_calls, {some('is_roaming = 1')} AS roaming_calls,
  {dec('SUM(duration_minutes)', 20, 2)} AS total_duration_min,
  {dec('SUM(data_consumed_mb)', 20, 2)} AS total_data_mb,
  {dec('SUM(revenue_qar)', 20, 3)} AS cdr_revenue_qar,
  {mean_round('duration_minutes', 2, 2, 12)} AS avg_call_duration_min,
  COUNT(DISTINCT network_type) AS network_types_used, MAX(call_date) AS last_call_date
FROM silver_cdr GROUP BY customer_id, call_month"""

CTE["recharge_monthly"] = f"""
SELECT customer_id, recharge_month AS call_month, COUNT(*) AS recharge_count,
  CAST(SUM(recharge_amount) AS DECIMAL(20,2)) AS recharge_revenue_qar,
  {mean('recharge_amount')} AS avg_recharge_amount, {some('is_digital_channel = 1')} AS digital_recharges
FROM silver_recharges GROUP BY customer_id, recharge_month"""

CTE["arpu_monthly"] = f"""
SELECT m.* , COALESCE(r.recharge_count, 0) AS recharge_count,
  COALESCE(r.recharge_revenue_qar, 0) AS recharge_revenue_qar, r.avg_recharge_amount, r.digital_recharges,
  c.segment, c.plan_type, c.plan_name, c.monthly_fee_qar, c.region, c.tenure_months, c.age_band, c.tenure_band,
  c.is_high_value, c.churn_risk,
  {dec('m.cdr_revenue_qar + COALESCE(r.recharge_revenue_qar, 0) + COALESCE(c.monthly_fee_qar, 0)', 20, 2)}
    AS total_revenue_qar,
  {div('m.dropped_calls * 100', 0, 'm.total_calls', 2, 9)} AS call_drop_rate_pct,
  {div('m.total_data_mb', 2, '1024', 3)} AS data_usage_gb,
  CASE WHEN c.churn_risk = 'High' AND m.total_calls < 5 THEN 1 ELSE 0 END AS is_churning_signal
FROM cdr_monthly m
LEFT JOIN recharge_monthly r ON r.customer_id = m.customer_id AND r.call_month = m.call_month
LEFT JOIN silver_customers c ON c.customer_id = m.customer_id"""

_PROFILE = """c.customer_id, c.segment, c.plan_type, c.plan_name, c.monthly_fee_qar, c.region, c.tenure_months,
  c.tenure_band, c.age_band, c.churn_risk, c.is_high_value, c.activation_date"""


def _summary(cdr_total, cdr_rows, minutes, timed, drops, days, rech_ids, rech_total, mb) -> str:
    arpu = f"{cdr_total} + COALESCE({rech_total}, 0) + c.monthly_fee_qar * 3"
    return f"""{days} AS active_days, CAST({cdr_rows} AS BIGINT) AS total_cdrs,
  {dec(cdr_total, 20, 2)} AS total_cdr_revenue, {div(mb, 2, '1024', 3)} AS total_data_gb,
  {div(minutes, 2, timed, 2, 12)} AS avg_call_duration,
  {div(f'{drops} * 100', 0, cdr_rows, 2, 9)} AS call_drop_rate_pct,
  CAST({rech_ids} AS BIGINT) AS total_recharges, {dec(rech_total, 20, 2)} AS total_recharge_amount,
  {div(arpu, 3, '3', 2)} AS avg_monthly_arpu"""


CTE["per_customer_cdr"] = """
SELECT customer_id, COUNT(DISTINCT call_date) AS days, COUNT(*) AS n, COUNT(cdr_id) AS ids, SUM(revenue_qar) AS revenue,
  SUM(data_consumed_mb) AS mb, SUM(duration_minutes) AS minutes, COUNT(duration_minutes) AS timed,
  SUM(is_dropped) AS drops, SUM(is_roaming) AS roaming, SUM(is_peak_hour) AS peak,
  COUNT(*) FILTER (WHERE network_type = '5G') AS calls_5g
FROM silver_cdr GROUP BY customer_id"""

CTE["per_customer_recharge"] = """
SELECT customer_id, COUNT(DISTINCT recharge_id) AS ids, COUNT(recharge_amount) AS n, SUM(recharge_amount) AS amount,
  COUNT(*) FILTER (WHERE is_digital_channel = 1) AS digital
FROM silver_recharges GROUP BY customer_id"""

CTE["customer_summary"] = f"""
SELECT {_PROFILE}, {_summary('d.revenue', 'COALESCE(d.ids, 0)', 'd.minutes', 'd.timed', 'd.drops',
    'COALESCE(d.days, 0)', 'COALESCE(r.ids, 0)', 'r.amount', 'd.mb')}
FROM silver_customers c LEFT JOIN per_customer_cdr d ON d.customer_id = c.customer_id
LEFT JOIN per_customer_recharge r ON r.customer_id = c.customer_id"""

CTE["customer_summary_fanout"] = f"""
SELECT {_PROFILE}, {_summary('SUM(d.revenue_qar)', 'COUNT(d.cdr_id)', 'SUM(d.duration_minutes)',
    'COUNT(d.duration_minutes)', 'SUM(d.is_dropped)', 'COUNT(DISTINCT d.call_date)',
    'COUNT(DISTINCT r.recharge_id)', 'SUM(r.recharge_amount)', 'SUM(d.data_consumed_mb)')}
FROM silver_customers c LEFT JOIN silver_cdr d ON d.customer_id = c.customer_id
LEFT JOIN silver_recharges r ON r.customer_id = c.customer_id
GROUP BY {_PROFILE}"""

CTE["regional_kpis"] = f"""
SELECT c.region, c.segment, COUNT(DISTINCT c.customer_id) AS customer_count, COUNT(d.cdr_id) AS total_calls,
  {dec('SUM(d.revenue_qar)', 20, 2)} AS total_cdr_revenue,
  {mean_round('d.duration_minutes', 2, 2, 12)} AS avg_duration_min,
  {div('SUM(d.data_consumed_mb)', 2, '1024', 2)} AS total_data_gb,
  {div('SUM(d.is_dropped) * 100', 0, 'COUNT(d.cdr_id)', 2, 9)} AS call_drop_rate_pct,
  {div('SUM(d.revenue_qar)', 3, 'COUNT(DISTINCT c.customer_id)', 2)} AS revenue_per_customer
FROM silver_customers c LEFT JOIN silver_cdr d ON d.customer_id = c.customer_id GROUP BY c.region, c.segment"""

CTE["daily_trend"] = f"""
SELECT call_date, call_month, COUNT(*) AS total_calls, COUNT(DISTINCT customer_id) AS active_customers,
  {dec('SUM(revenue_qar)', 20, 2)} AS daily_revenue, {div('SUM(data_consumed_mb)', 2, '1024', 2)} AS daily_data_gb,
  {mean_round('duration_minutes', 2, 2, 12)} AS avg_call_duration,
  {some('is_dropped = 1')} AS dropped_calls, {some('is_roaming = 1')} AS roaming_calls,
  {some("network_type = '5G'")} AS calls_5g, {some("network_type = '4G'")} AS calls_4g
FROM silver_cdr GROUP BY call_date, call_month"""

_FEATURE_PROFILE = """c.customer_id, CASE WHEN c.churn_risk = 'High' THEN 1 ELSE 0 END AS label, c.tenure_months,
  c.monthly_fee_qar, c.data_allowance_gb, CASE WHEN c.plan_type = 'PREPAID' THEN 1 ELSE 0 END AS is_prepaid,
  CASE c.segment WHEN 'Low Value' THEN 0 WHEN 'Mid Value' THEN 1 WHEN 'High Value' THEN 2 ELSE 3 END
    AS segment_encoded"""


def _features(rows, revenue, minutes, timed, mb, drops, days, roaming, five, peak, n, ids, amount, rn, digital) -> str:
    def zero(expr, kind):
        return f"COALESCE(CAST({expr} AS {kind}), 0)"

    return f"""{zero(rows, 'BIGINT')} AS total_calls, {zero(revenue, 'DECIMAL(24,3)')} AS total_cdr_revenue,
  COALESCE(CAST({minutes} AS DOUBLE) / NULLIF({timed}, 0), 0) AS avg_call_duration,
  COALESCE(CAST({mb} AS DOUBLE) / 1024, 0) AS total_data_gb, {zero(drops, 'BIGINT')} AS dropped_calls,
  COALESCE(CAST({drops} * 100 AS DOUBLE) / NULLIF({rows}, 0), 0) AS drop_rate_pct,
  {zero(days, 'BIGINT')} AS active_days, {zero(roaming, 'BIGINT')} AS roaming_calls,
  {zero(five, 'BIGINT')} AS calls_5g, COALESCE(CAST({peak} AS DOUBLE) / NULLIF({n}, 0), 0) AS peak_hour_ratio,
  {zero(ids, 'BIGINT')} AS total_recharges, {zero(amount, 'DECIMAL(24,2)')} AS total_recharge_amount,
  COALESCE(CAST({amount} AS DOUBLE) / NULLIF({rn}, 0), 0) AS avg_recharge_amount,
  {zero(digital, 'BIGINT')} AS digital_recharges"""


CTE["churn_features"] = f"""
SELECT {_FEATURE_PROFILE}, {_features('d.ids', 'd.revenue', 'd.minutes', 'd.timed', 'd.mb', 'd.drops', 'd.days',
    'd.roaming', 'd.calls_5g', 'd.peak', 'd.n', 'r.ids', 'r.amount', 'r.n', 'r.digital')}
FROM silver_customers c LEFT JOIN per_customer_cdr d ON d.customer_id = c.customer_id
LEFT JOIN per_customer_recharge r ON r.customer_id = c.customer_id"""

CTE["churn_features_fanout"] = f"""
SELECT {_FEATURE_PROFILE}, {_features('COUNT(d.cdr_id)', 'SUM(d.revenue_qar)', 'SUM(d.duration_minutes)',
    'COUNT(d.duration_minutes)', 'SUM(d.data_consumed_mb)', 'SUM(d.is_dropped)', 'COUNT(DISTINCT d.call_date)',
    'SUM(d.is_roaming)', "COUNT(*) FILTER (WHERE d.network_type = '5G')", 'SUM(d.is_peak_hour)',
    'COUNT(d.is_peak_hour)', 'COUNT(DISTINCT r.recharge_id)', 'SUM(r.recharge_amount)', 'COUNT(r.recharge_amount)',
    'COUNT(*) FILTER (WHERE r.is_digital_channel = 1)')}
FROM silver_customers c LEFT JOIN silver_cdr d ON d.customer_id = c.customer_id
LEFT JOIN silver_recharges r ON r.customer_id = c.customer_id
GROUP BY ALL"""

CTE["rule_scores"] = """
SELECT *, CASE WHEN churn_probability >= 0.70 THEN 'High Risk' WHEN churn_probability >= 0.40 THEN 'Medium Risk'
    ELSE 'Low Risk' END AS churn_score_band, CASE WHEN churn_probability >= 0.70 THEN 1 ELSE 0 END AS is_high_churn_risk
FROM (SELECT customer_id, CAST(((CAST(substr(customer_id, 5) AS BIGINT) * 37 + total_calls * 7 + active_days * 3
    + total_recharges * 11) % 101) * 0.0099 AS DECIMAL(12,9))
    AS churn_probability, label, tenure_months, monthly_fee_qar, total_calls, drop_rate_pct, total_recharges, active_days
  FROM churn_features) t"""

CTE["customer_360_core"] = """
SELECT customer_id, segment, plan_type, plan_name, region, tenure_band, age_band, churn_risk, is_high_value,
  monthly_fee_qar, active_days, total_cdrs, total_cdr_revenue, total_data_gb,
  avg_call_duration AS avg_call_duration_min, call_drop_rate_pct, total_recharges, total_recharge_amount,
  avg_monthly_arpu
FROM customer_summary"""

CTE["customer_360_rule"] = f"""
SELECT c.*, {dec('s.churn_probability * 100', 5, 1)} AS churn_probability_pct, s.churn_score_band,
  s.is_high_churn_risk
FROM customer_360_core c LEFT JOIN rule_scores s ON s.customer_id = c.customer_id"""

CTE["vw_arpu_monthly_trend"] = f"""
SELECT call_month, segment, plan_type, region, COUNT(DISTINCT customer_id) AS customer_count,
  {mean_round('total_revenue_qar', 2, 2)} AS avg_arpu, {dec('SUM(total_revenue_qar)', 24, 2)} AS total_revenue,
  {mean_round('call_drop_rate_pct', 2, 2, 9)} AS avg_drop_rate, {mean_round('data_usage_gb', 3, 3)} AS avg_data_gb,
  CAST(SUM(total_calls) AS BIGINT) AS total_calls, CAST(SUM(is_churning_signal) AS BIGINT) AS churn_signals
FROM arpu_monthly GROUP BY call_month, segment, plan_type, region"""

CTE["vw_executive_kpis"] = f"""
SELECT COUNT(DISTINCT customer_id) AS total_customers, {mean_round('avg_monthly_arpu', 2, 2)} AS overall_arpu_qar,
  {dec('SUM(total_cdr_revenue)', 24, 2)} AS total_revenue_qar,
  {mean_round('call_drop_rate_pct', 2, 2, 9)} AS avg_drop_rate_pct,
  {mean_round('total_data_gb', 3, 3)} AS avg_data_gb_per_customer,
  COUNT(*) FILTER (WHERE churn_risk = 'High') AS high_churn_customers,
  COUNT(*) FILTER (WHERE is_high_value = 1) AS high_value_customers,
  {div("COUNT(*) FILTER (WHERE churn_risk = 'High') * 100", 0, 'COUNT(*)', 2, 9)} AS churn_risk_pct
FROM customer_summary"""

_REGION = f"""region, CAST(SUM(customer_count) AS BIGINT) AS total_customers,
  {dec('SUM(total_cdr_revenue)', 24, 2)} AS total_revenue,
  {mean_round('avg_duration_min', 2, 2, 12)} AS avg_call_duration,
  {mean_round('call_drop_rate_pct', 2, 2, 9)} AS avg_drop_rate,
  {dec('SUM(total_data_gb)', 24, 2)} AS total_data_gb,
  {mean_round('revenue_per_customer', 2, 2)} AS avg_revenue_per_customer"""
CTE["vw_regional_performance"] = f"SELECT {_REGION} FROM regional_kpis GROUP BY region"

CTE["raw_events"] = """
SELECT event_id AS k, ts AS enqueued_time, CAST(event_id % 32 AS VARCHAR) AS eh_partition,
  CAST(event_id AS VARCHAR) AS eh_offset, event_id % 97 = 0 AS garbage,
  'EVT' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id,
  CASE event_type WHEN 'error' THEN 'call_dropped' WHEN 'purchase' THEN 'recharge_completed'
    WHEN 'view' THEN 'data_session_start' WHEN 'click' THEN 'data_session_end' ELSE 'call_initiated' END AS event_type,
  CASE WHEN event_id % 89 <> 0 THEN 'CUST' || lpad(CAST(user_id AS VARCHAR), 12, '0') END AS customer_id,
  '+9743' || lpad(CAST(user_id % 10000000 AS VARCHAR), 7, '0') AS msisdn,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
  (['4G','5G','3G','WiFi Calling'])[CAST(event_id % 4 AS INT) + 1] AS network_type,
  'TOWER_' || (event_id % 20) AS tower_id, trim(c.region) AS region, trim(c.segment) AS segment,
  trim(c.plan_name) AS plan_name, trim(c.churn_risk) AS churn_risk,
  CASE WHEN event_type = 'error' THEN CAST(floor(value) AS INTEGER) END AS duration_seconds,
  CASE WHEN event_type IN ('view', 'click') THEN value END AS data_mb,
  CASE WHEN event_type IN ('error', 'signup') THEN 'Voice' WHEN event_type IN ('view', 'click') THEN 'Data' END
    AS call_type,
  CAST(-120 + event_id % 70 AS INTEGER) AS signal_strength,
  CASE WHEN event_type = 'purchase' THEN value END AS recharge_amount,
  CASE WHEN event_type = 'purchase' THEN 'USSD' END AS recharge_channel, CAST(NULL AS VARCHAR) AS roaming_country
FROM events LEFT JOIN bronze_customers c ON c.customer_id = 'CUST' || lpad(CAST(user_id AS VARCHAR), 12, '0')"""

CTE["silver_events"] = """
SELECT event_id, event_type, customer_id, msisdn, event_time, network_type, tower_id, region, segment, plan_name,
  churn_risk, COALESCE(duration_seconds, 0) AS duration_seconds, COALESCE(data_mb, 0.0) AS data_mb, call_type,
  signal_strength, recharge_amount, recharge_channel, roaming_country,
  strftime(enqueued_time, '%Y-%m-%d %H:%M:%S') AS enqueued_time, eh_partition, eh_offset,
  CASE WHEN event_type = 'call_dropped' THEN 1 ELSE 0 END AS is_dropped,
  CASE WHEN event_type = 'recharge_completed' THEN 1 ELSE 0 END AS is_recharge,
  CASE WHEN event_type IN ('data_session_start', 'data_session_end') THEN 1 ELSE 0 END AS is_data_event,
  CASE WHEN churn_risk = 'High' THEN 1 ELSE 0 END AS is_high_churn_customer
FROM raw_events WHERE NOT garbage AND customer_id IS NOT NULL"""

CTE["alerts"] = """
SELECT customer_id, msisdn, event_type, event_time, region, segment, plan_name, churn_risk, enqueued_time,
  'CHURN_RISK_ACTIVITY' AS alert_type
FROM silver_events
WHERE churn_risk = 'High' AND event_type IN ('call_dropped', 'data_session_end', 'recharge_completed')"""


def sql(query: str) -> str:
    """The query with the CTEs it needs, directly or through others, in order."""

    def used(text):
        return {n for n in CTE if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", text)}

    needed, todo = set(), used(query)
    while todo:
        needed |= todo
        todo = set().union(*(used(CTE[n]) for n in todo)) - needed
    parts = [f"{n} AS ({CTE[n].strip()})" for n in CTE if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + query.strip()
