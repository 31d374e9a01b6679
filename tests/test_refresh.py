"""Landed rows to Silver and Gold, compared with a run over everything at once."""

import os
import time

import frames
import pytest

from cdrlake import schemas
from cdrlake.config import RunConfig
from cdrlake.operators import control, gold, silver
from cdrlake.plans.batch import clustered_cdr, run_batch
from cdrlake.plans.incremental import full_reload_customers, incremental_load
from cdrlake.plans.refresh import refresh
from cdrlake.session import TIDY, tidy_shuffles
from cdrlake.sinks import tables as sinks
from cdrlake.sources import files
from cdrlake.sources.tables import read_table


@pytest.fixture
def lake(spark, tmp_path):
    cfg = RunConfig(str(tmp_path / "lake"))
    marks = control.ControlTable(spark, f"{cfg.base}/control/watermarks")
    marks.init(control.init_watermarks(spark))
    full_reload_customers(frames.customers(spark, {}, {"customer_id": "B"}), cfg.path("landing", "customers"), marks)
    return cfg, marks


def arrive(spark, cfg, marks, name, cdrs=(), recharges=()):
    """New files arrive and are loaded and refreshed."""
    for kind, rows, make, schema, pipeline in (
        ("cdrs", cdrs, frames.cdr, schemas.CDR, "cdrs_incremental_load"),
        ("recharges", recharges, frames.recharges, schemas.RECHARGE, "recharges_incremental"),
    ):
        if rows:
            sinks.write_csv(make(spark, *rows), cfg.bronze(f"{kind}/{kind}_{name}"))
        if os.path.exists(cfg.bronze(kind)):
            incremental_load(spark, cfg.bronze(kind), kind, schema, cfg.path("landing", kind), marks, pipeline)
    return refresh(spark, cfg)


def all_at_once(spark, cfg, tmp_path, cdrs, recharges):
    """The Gold and Silver tables of one run over all rows."""
    whole = RunConfig(str(tmp_path / "whole"))
    sinks.write_csv(frames.customers(spark, {}, {"customer_id": "B"}), whole.bronze("customers"))
    sinks.write_csv(frames.cdr(spark, *cdrs), whole.bronze("cdrs"))
    sinks.write_csv(frames.recharges(spark, *recharges), whole.bronze("recharges"))
    run_batch(spark, whole)
    return whole


TABLES = [("silver", "cdrs"), ("silver", "recharges"), ("gold", "arpu_monthly"), ("gold", "customer_summary"), ("gold", "daily_trend"), ("gold", "regional_kpis")]


def test_refreshes_equal_one_run(spark, lake, tmp_path, rows):
    cfg, marks = lake
    first = [
        {"cdr_id": "1", "call_date": "2024-10-05", "call_start_dttm": "2024-10-05 10:00:00"},
        {"cdr_id": "2", "call_date": "2024-11-05", "call_start_dttm": "2024-11-05 10:00:00"},
        {"cdr_id": "3", "call_date": "2024-12-05", "call_start_dttm": "2024-12-05 10:00:00", "customer_id": "B"},
    ]
    second = [
        # an earlier row of id 2, in another month: November loses its only row
        {"cdr_id": "2", "call_date": "2024-10-06", "call_start_dttm": "2024-10-06 10:00:00"},
        # a later row of id 3, which loses; a bad first copy of id 1, which takes the good one with it
        {"cdr_id": "3", "call_date": "2025-01-05", "call_start_dttm": "2025-01-05 10:00:00"},
        {"cdr_id": "1", "call_date": "2024-13-45", "call_start_dttm": "2024-10-01 10:00:00"},
        {"cdr_id": None, "call_date": "2024-10-07", "call_start_dttm": "2024-10-07 10:00:00"},
    ]
    third = [{"cdr_id": None, "call_date": "2024-09-07", "call_start_dttm": "2024-09-07 10:00:00"}]
    recharges = [{"recharge_id": "1"}, {"recharge_id": "1", "recharge_dttm": "2024-09-01 00:00:00", "recharge_month": "2024-09"}]
    arrive(spark, cfg, marks, "2024_10", first, recharges[:1])
    assert read_table(spark, cfg.base, "silver", "cdrs").count() == 3
    run = arrive(spark, cfg, marks, "2024_11", second, recharges[1:])
    assert run.detail["months"]["cdrs"] == ["2024-10", "2024-11", "2024-12", "2025-01"]
    assert "2024-11" not in {r.call_month for r in read_table(spark, cfg.base, "silver", "cdrs").collect()}
    run = arrive(spark, cfg, marks, "2024_12", third)
    assert run.detail["months"] == {"cdrs": ["2024-09", "2024-10"], "recharges": []}
    whole = all_at_once(spark, cfg, tmp_path, first + second + third, recharges)
    for layer, name in TABLES:
        a, b = (read_table(spark, c.base, layer, name) for c in (cfg, whole))
        columns = sorted(c for c in a.columns if not c.endswith(("load_dttm", "load_dt")) and c != "source_system")
        assert rows(a, *columns) == rows(b, *columns), name
    assert not [n for c in (cfg, whole) for n in os.listdir(c.path("work", "")) if n.endswith(("_refreshed", "_checked"))]
    again = refresh(spark, cfg)
    assert again.detail["months"] == {"cdrs": [], "recharges": []} and again.rows_written["cdrs"] == 0
    audit = sinks.read_merged(spark, cfg.path("control", "audit")).where("pipeline_name = 'refresh'")
    assert {r.status for r in audit.collect()} == {"SUCCESS"} and audit.count() == 4


def test_a_refresh_without_landed_rows_fails_with_its_row(spark, tmp_path):
    cfg = RunConfig(str(tmp_path))
    with pytest.raises(Exception, match="landing"):
        refresh(spark, cfg)
    row = sinks.read_merged(spark, cfg.path("control", "audit")).first()
    assert row.status == "FAILED" and "landing" in row.error_message


def test_a_catalog_entry_follows_its_folder(spark, tmp_path):
    base = str(tmp_path)

    def stored(columns, by=None):
        df = spark.createDataFrame([(1, "a", 2.0)], "v int, k string, w double").select(*columns)
        sinks.write_table(df, f"{base}/gold/t", by)
        return sinks.register_catalog(spark, "cdr_change_test", base, ["t"], location=f"{base}/db")

    try:
        assert stored(["v", "k"]) == [] and spark.table("cdr_change_test.t").columns == ["v", "k"]
        assert stored(["v", "k"]) == []
        assert stored(["v", "k", "w"]) == ["t"]
        assert spark.sql("SELECT w FROM cdr_change_test.t").collect() == [(2.0,)]
        stored(["v", "k", "w"], "k")
        assert spark.sql("SELECT v, k, w FROM cdr_change_test.t WHERE k = 'a'").collect() == [(1, "a", 2.0)]
    finally:
        spark.sql("DROP DATABASE IF EXISTS cdr_change_test CASCADE")


def test_derived_columns_are_made_after_the_layout(spark, tmp_path):
    """They were sorted and shuffled with the rows."""
    sinks.write_table(frames.cdr(spark, {"cdr_id": "C1"}, {"cdr_id": "C2"}).transform(silver.checked_cdr).drop("reject_reason"), str(tmp_path / "good"))
    rows = clustered_cdr(spark.read.parquet(str(tmp_path / "good")))
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    above, below = plan.split("RepartitionByExpression", 1)
    assert "time_of_day" in above and "time_of_day" not in below
    plain = silver.cdr_features(spark.read.parquet(str(tmp_path / "good")))
    assert sorted(rows.drop("source_system", "silver_load_dttm").columns) == sorted(plain.drop("source_system").columns)
    assert {r.call_month for r in rows.collect()} == {"2024-10"}


def test_shuffles_go_with_their_query(spark, tmp_path):
    """They stayed until the driver collected its garbage, those of a whole run at a time."""

    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before, set_before = left(), spark.conf.get(TIDY, None)
    with tidy_shuffles(spark), tidy_shuffles(spark):
        sinks.write_table(spark.range(1000).selectExpr("id", "cast(id % 3 as string) as k"), str(tmp_path / "t"), "k")
        until = time.time() + 20
        while left() - before and time.time() < until:
            time.sleep(0.2)
        assert not left() - before
    assert spark.conf.get(TIDY, None) == set_before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_arpu_is_made_after_its_months_are_brought_together(spark):
    """Measures moved with the rows."""
    cdr, recharged, people = silver.silver_cdr(frames.cdr(spark, {})), silver.silver_recharges(frames.recharges(spark, {})), silver.silver_customers(frames.customers(spark, {}))
    sides = gold.cdr_monthly(gold.usage_rows(cdr)), gold.recharge_monthly(recharged), people
    laid_out = gold.arpu_measures(gold.arpu_parts(*sides).hint("rebalance", "call_month"))
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    above, below = laid_out._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions", 1)
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "total_revenue_qar" in above and "total_revenue_qar" not in below
    assert laid_out.collect() == gold.gold_arpu(*sides).collect()


def test_landed_csv_can_be_compressed(spark, tmp_path):
    df = frames.cdr(spark, {"cdr_id": " C1 "}, {"cdr_id": "C2", "region": None})
    sinks.write_csv(df, str(tmp_path / "cdrs"), compression="gzip")
    assert list((tmp_path / "cdrs").glob("*.csv.gz"))
    assert sorted(map(str, files.read_csv(spark, str(tmp_path / "cdrs"), schemas.CDR).collect())) == sorted(map(str, df.collect()))
