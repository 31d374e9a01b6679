"""Small Bronze rows for unit tests."""

from cdrlake import schemas

CDR = {
    "cdr_id": "C1", "customer_id": "A", "msisdn": "+97430000001", "call_type": " voice ",
    "call_start_dttm": "2024-10-01 08:00:00", "call_end_dttm": "2024-10-01 08:01:30", "duration_seconds": 90,
    "network_type": "5g", "data_consumed_mb": None, "termination_code": "user_dropped", "is_roaming": 0,
    "roaming_country": None, "revenue_qar": 1.5, "plan_type": "Prepaid", "plan_name": "P", "region": " Doha ",
    "segment": "VIP ", "call_date": "2024-10-01", "call_hour": 8, "created_at": "x",
}
CUSTOMER = {
    "customer_id": "A", "msisdn": "+97430000001", "first_name": "f", "last_name": "l", "age": 30,
    "nationality": " N ", "language": "E", "region": " Doha ", "device_type": "Tablet", "plan_type": " prepaid",
    "plan_name": " P ", "monthly_fee_qar": 10.0, "data_allowance_gb": 5, "activation_date": "2024-01-01",
    "tenure_months": 9, "segment": " VIP", "churn_risk": "High ", "is_active": 1, "created_at": "x",
    "updated_at": "2024-01-01 00:00:00",
}
RECHARGE = {
    "recharge_id": "R1", "customer_id": "A", "msisdn": "+97430000001", "recharge_amount": 20.0,
    "recharge_channel": " IVR ", "recharge_dttm": "2024-10-02 10:00:00", "validity_days": 7,
    "expiry_dttm": "2024-10-09 10:00:00", "plan_name": "P", "segment": "VIP", "region": "Doha",
    "churn_risk": "High", "recharge_month": "2024-10", "recharge_date": "2024-10-02", "created_at": "x",
}


def _frame(spark, base, schema, rows):
    data = [tuple((base | r)[n] for n in schema.names) for r in rows]
    return spark.createDataFrame(data, schema)


def cdr(spark, *rows):
    return _frame(spark, CDR, schemas.CDR, rows)


def customers(spark, *rows):
    return _frame(spark, CUSTOMER, schemas.CUSTOMER, rows)


def recharges(spark, *rows):
    return _frame(spark, RECHARGE, schemas.RECHARGE, rows)
