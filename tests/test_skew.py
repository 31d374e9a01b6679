"""A third of the rows under one id and a third under one customer, by brute force."""

from collections import defaultdict
from decimal import Decimal

import frames
import pytest
from pyspark.sql import functions as F

from cdrlake.operators import gold, quality, silver
from cdrlake.sinks.tables import together

N = 6000


def parts(i):
    cdr_id = "DUP" if i % 3 == 0 else f"C{i}"
    customer = "HOT" if i % 3 == 1 else f"c{i % 50}"
    return cdr_id, customer, 1 + i % 28, i % 100


@pytest.fixture(scope="module")
def bronze(spark):
    ids = spark.range(0, N, 1, 6)
    i = F.col("id")
    day = F.lpad((1 + i % 28).cast("string"), 2, "0")
    columns = {
        **{k: F.lit(v) for k, v in frames.CDR.items()},
        "cdr_id": F.when(i % 3 == 0, "DUP").otherwise(F.concat(F.lit("C"), i.cast("string"))),
        "customer_id": F.when(i % 3 == 1, "HOT").otherwise(F.concat(F.lit("c"), (i % 50).cast("string"))),
        "call_date": F.concat(F.lit("2024-10-"), day),
        "call_start_dttm": F.date_format(F.timestamp_seconds(1727740800 + i), "yyyy-MM-dd HH:mm:ss"),
        "revenue_qar": (i % 100) / 10,
    }
    kinds = {f.name: f.dataType for f in frames.cdr(spark, {}).schema.fields}
    return ids.select(*[columns[c].cast(kinds[c]).alias(c) for c in kinds])


@pytest.fixture(scope="module")
def kept():
    """Rows after duplicate removal: of the copies only the first start remains."""
    return [parts(i) for i in range(N) if i % 3 or i == 0]


def test_one_copy_of_a_hot_id_remains(bronze):
    counts = quality.duplicate_count(bronze, "cdr_id").first()
    assert tuple(counts) == (N, 2 * N // 3 + 1, N // 3 - 1)
    assert silver.unique_cdr(bronze).where("cdr_id = 'DUP'").first().call_start_dttm.second == 0


def test_gold_with_a_hot_customer(spark, bronze, kept):
    calls, revenue, days, actives = defaultdict(int), defaultdict(Decimal), defaultdict(set), defaultdict(set)
    for _, customer, day, tenth in kept:
        calls[customer] += 1
        revenue[customer] += Decimal(tenth) / 10
        days[customer].add(day)
        actives[day].add(customer)
    usage = gold.usage_rows(silver.silver_cdr(bronze))
    monthly = {r.customer_id: (r.total_calls, r.cdr_revenue_qar) for r in gold.cdr_monthly(usage).collect()}
    assert monthly == {c: (calls[c], revenue[c]) for c in calls}
    totals = {r.customer_id: r.days for r in gold.usage_by_customer(usage).collect()}
    assert totals == {c: len(d) for c, d in days.items()}
    daily = {r.call_date.day: r.active_customers for r in gold.daily_trend(usage).collect()}
    assert daily == {d: len(c) for d, c in actives.items()}


def test_fanout_totals_equal_the_join(spark, bronze):
    """The multiplied totals against the literal three-way join, on a small fixture."""
    cdr = silver.silver_cdr(bronze)
    customers = silver.silver_customers(
        frames.customers(spark, *[{"customer_id": c} for c in ("HOT", "c1", "c2", "none")])
    )
    recharges = silver.silver_recharges(
        frames.recharges(
            spark, *[{"recharge_id": f"R{i}", "customer_id": "HOT" if i % 3 else "c1", "recharge_amount": 1.0 + i} for i in range(9)]
        )
    )
    joined = customers.join(cdr, "customer_id", "left").join(recharges, "customer_id", "left")
    want = joined.groupBy("customer_id").agg(
        F.count("cdr_id"),
        F.sum("revenue_qar").cast("decimal(20,2)"),
        F.count_distinct("recharge_id"),
        F.sum("recharge_amount").cast("decimal(20,2)"),
    )
    got = gold.customer_summary(customers, gold.usage_rows(cdr), recharges, fanout=True).select(
        "customer_id", "total_cdrs", "total_cdr_revenue", "total_recharges", "total_recharge_amount"
    )
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_a_failing_job_is_reported():
    with pytest.raises(ZeroDivisionError):
        together({"good": lambda: 1, "bad": lambda: 1 // 0})
    assert together({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}
