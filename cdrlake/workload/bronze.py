"""Bronze entities made from the test tables (``TESTDATA.md``).

Every row of the source tables is used.  The expressions also plant what the
operators must cope with: padded and lower-case codes, unparseable dates, missing
ids, negative and missing amounts, repeated keys, callers who are not customers
and customers without recharges.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schemas
from ..sources.tables import spread_small

# Schemas of the source files; naming them saves a pass over the file footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _id(prefix: str, key: str) -> str:
    return f"concat('{prefix}', lpad(cast({key} as string), 12, '0'))"


def _msisdn(key: str) -> str:
    return f"concat('+9743', lpad(cast({key} % 10000000 as string), 7, '0'))"


def _pick(index: str, values: list[str]) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values[:-1]))
    return f"case {index} {whens} else '{values[-1]}' end"


def _text(ts: str) -> str:
    return f"cast(cast({ts} as timestamp_ntz) as string)"


def _typed(df: DataFrame, columns: dict[str, str], schema: StructType, *more: str) -> DataFrame:
    return df.selectExpr(
        *[f"cast({columns[f.name]} as {f.dataType.simpleString()}) as {f.name}" for f in schema.fields], *more
    )


PLANS = [f"Plan {c} " for c in "ABCDEFGH"]
PROFILE = ["plan_type", "plan_name", "region", "segment", "churn_risk"]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    tenure = "(1 + (c_custkey * 7) % 60)"
    columns = {
        "customer_id": _id("CUST", "c_custkey"),
        "msisdn": f"case when c_custkey % 31 <> 0 then {_msisdn('c_custkey')} end",
        "first_name": "c_name",
        "last_name": "c_name",
        "age": "case when c_custkey % 37 <> 0 then 16 + (c_custkey * 13) % 52 end",
        "nationality": "concat(' ', n_name)",
        "language": _pick("c_custkey % 3", ["Arabic", "English", "Hindi"]),
        "region": "concat(r_name, ' ')",
        "device_type": _pick("c_custkey % 2", ["Smartphone", "Tablet"]),
        "plan_type": _pick("c_custkey % 2", [" Prepaid", "Postpaid"]),
        "plan_name": _pick("c_custkey % 8", PLANS),
        "monthly_fee_qar": "case when c_custkey % 29 <> 0 then 10 + 45 * (c_custkey % 8) end",
        "data_allowance_gb": "5 * (1 + c_custkey % 8)",
        "activation_date": f"case when c_custkey % 23 <> 0"
        f" then cast(date_sub(date'2024-12-31', cast({tenure} * 30 as int)) as string) else '31/12/2024' end",
        "tenure_months": f"case when c_custkey % 41 <> 0 then {tenure} end",
        "segment": "case c_mktsegment when 'BUILDING' then ' Low Value' when 'MACHINERY' then 'High Value'"
        " when 'FURNITURE' then 'VIP ' else 'Mid Value' end",
        "churn_risk": "case when c_acctbal < 1000 then 'High' when c_acctbal < 4000 then ' Medium' else 'Low ' end",
        "is_active": "case when c_custkey % 20 <> 0 then 1 else 0 end",
        "created_at": "'2024-12-31 00:00:00'",
        "updated_at": "'2024-12-31 00:00:00'",
    }
    joined = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    return _typed(joined, columns, schemas.CUSTOMER)


LINE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_shipdate",
]


def cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CDR per line item, called by the customer of its order, with copies of the customer's attributes."""
    return cdr_of(called_lines(spark, sf_dir))


def called_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the customer of their order: what :func:`cdr_of` needs, in fewer bytes than its texts."""
    line = table(spark, sf_dir, "lineitem")
    # the profile is joined to the orders, which are fewer and narrower than their lines
    names = _profile_of(schemas.CDR)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orders = _join_profile(spark, sf_dir, orders, "o_custkey", names).drop("known_id")
    return line.join(orders, line.l_orderkey == orders.o_orderkey).select(*LINE, "o_custkey", *names)


def cdr_of(lines: DataFrame, *more: str) -> DataFrame:
    """The CDRs of the lines, with columns of ``more`` as they are."""
    start = "timestampadd(SECOND, (l_partkey % 24) * 3600 + l_suppkey % 3600, l_shipdate)"
    seconds = "case when l_linenumber = 5 then 0 else cast(l_quantity * 37 as int) end"
    amount = "cast(l_extendedprice as decimal(10,2)) * cast(l_discount * 10 as decimal(3,1))"
    tax, roaming = "cast(l_tax as decimal(4,2))", "cast(l_discount as decimal(4,2)) >= 0.09"
    columns = {
        "cdr_id": f"concat({_id('CDR', 'l_orderkey')}, '-', l_linenumber)",
        "customer_id": f"case when l_suppkey % 41 = 0 then null when o_custkey % 17 = 0"
        f" then {_id('VISIT', 'o_custkey')} else {_id('CUST', 'o_custkey')} end",
        "msisdn": _msisdn("o_custkey"),
        "call_type": _pick(
            "l_linenumber - 1", [" Voice", "voice ", "Data", "DATA", "SMS", "Video Call", "IDD Voice"]
        ),
        "call_start_dttm": f"case when l_partkey % 59 <> 0 then {_text(start)} end",
        "call_end_dttm": _text(f"timestampadd(SECOND, {seconds}, {start})"),
        "duration_seconds": seconds,
        "network_type": _pick("l_suppkey % 5", ["4G", "5G", "3g", " 2G", "WiFi Calling"]),
        "data_consumed_mb": "case when l_linenumber in (3, 4) then l_extendedprice end",
        "termination_code": "case l_returnflag when 'N' then 'normal ' when 'A' then 'BUSY' else 'User_Dropped' end",
        "is_roaming": f"case when {roaming} then 1 else 0 end",
        "roaming_country": f"case when {roaming} then 'UAE' end",
        "revenue_qar": f"case when {tax} = 0.07 and l_linenumber = 5 then null"
        f" when {tax} = 0.08 then -({amount}) else {amount} end",
        "call_date": "case when l_partkey % 53 = 0 then '2024-13-45' else cast(cast(l_shipdate as date) as string) end",
        "call_hour": "case when l_partkey % 61 <> 0 then l_partkey % 24 end",
        "created_at": _text("l_shipdate"),
    }
    return _typed(lines, columns | {n: n for n in _profile_of(schemas.CDR)}, schemas.CDR, *more)


def recharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recharge per order; buyers with odd keys buy for the prepaid neighbour."""
    orders = spread_small(table(spark, sf_dir, "orders"), "o_orderkey")
    at, valid = "o_orderkey % 86400", "7 + o_orderkey % 53"
    amount = "(o_orderkey * 13 + o_custkey * 7) % 200"
    columns = {
        "recharge_id": _id("RCH", "(o_orderkey - case when o_orderkey % 10 = 9 then 1 else 0 end)"),
        "customer_id": f"case when o_orderkey % 43 <> 0 then {_id('CUST', 'prepaid_key')} end",
        "msisdn": _msisdn("prepaid_key"),
        "recharge_amount": f"case when o_orderkey % 7 = 0 then -({amount})"
        f" when o_orderkey % 47 <> 0 then {amount} + 0.25 end",
        "recharge_channel": "case substring(o_orderpriority, 1, 1) when '1' then 'Mobile App' when '2' then ' USSD'"
        " when '3' then 'Web Portal' when '4' then 'Retailer' else 'IVR ' end",
        "recharge_dttm": _text(f"timestampadd(SECOND, {at}, o_orderdate)"),
        "validity_days": valid,
        "expiry_dttm": _text(f"timestampadd(SECOND, {at} + ({valid}) * 86400, o_orderdate)"),
        "recharge_month": "substring(cast(cast(o_orderdate as date) as string), 1, 7)",
        "recharge_date": "cast(cast(o_orderdate as date) as string)",
        "created_at": _text("o_orderdate"),
    }
    base = orders.selectExpr("*", "o_custkey - o_custkey % 2 as prepaid_key")
    names = _profile_of(schemas.RECHARGE)
    joined = _join_profile(spark, sf_dir, base, "prepaid_key", names)
    return _typed(joined, columns | {n: n for n in names}, schemas.RECHARGE)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured broker messages: (body, enqueuedTime, partition, offset).

    The body is JSON bytes with the customer's attributes, as the producer sends
    them; a few bodies are not JSON and a few lack the customer.
    """
    ev = spread_small(table(spark, sf_dir, "events"), "event_id")
    columns = {
        "event_id": _id("EVT", "event_id"),
        "event_type": "case event_type when 'error' then 'call_dropped' when 'purchase' then 'recharge_completed'"
        " when 'view' then 'data_session_start' when 'click' then 'data_session_end' else 'call_initiated' end",
        "customer_id": f"case when event_id % 89 <> 0 then {_id('CUST', 'user_id')} end",
        "msisdn": _msisdn("user_id"),
        "event_time": f"concat(replace({_text('date_trunc(\'SECOND\', ts)')}, ' ', 'T'), 'Z')",
        "network_type": _pick("event_id % 4", ["4G", "5G", "3G", "WiFi Calling"]),
        "tower_id": "concat('TOWER_', event_id % 20)",
        "duration_seconds": "case when event_type = 'error' then floor(value) end",
        "data_mb": "case when event_type in ('view', 'click') then value end",
        "call_type": "case when event_type in ('error', 'signup') then 'Voice'"
        " when event_type in ('view', 'click') then 'Data' end",
        "signal_strength": "-120 + event_id % 70",
        "recharge_amount": "case when event_type = 'purchase' then value end",
        "recharge_channel": "case when event_type = 'purchase' then 'USSD' end",
        "roaming_country": "null",
        **{name: f"trim({name})" for name in ("region", "segment", "plan_name", "churn_risk")},
    }
    joined = _join_profile(spark, sf_dir, ev, "user_id", PROFILE)
    fields = ", ".join(
        f"'{f.name}', cast({columns[f.name]} as {f.dataType.simpleString()})" for f in schemas.EVENT.fields
    )
    return joined.selectExpr(
        "cast(case when event_id % 97 = 0 then concat('garbage ', event_id)"
        f" else to_json(named_struct({fields})) end as binary) as body",
        "cast(ts as timestamp) as enqueuedTime",
        "cast(event_id % 32 as int) as partition",
        "cast(event_id as string) as offset",
    )


def _join_profile(spark, sf_dir, df, key: str, names: list[str]) -> DataFrame:
    known = customers(spark, sf_dir).selectExpr("customer_id as known_id", *names)
    keyed = df.selectExpr("*", f"{_id('CUST', key)} as known_id")
    return keyed.join(known, "known_id", "left")


def _profile_of(schema: StructType) -> list[str]:
    return [n for n in PROFILE if n in schema.names]
