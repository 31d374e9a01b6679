"""Registered queries against DuckDB, and the shape of their plans."""

import re
from concurrent.futures import ThreadPoolExecutor

import compare
import pytest

import __spark_entry__ as entry
from cdrlake.workload import queries as landing
from cdrlake.workload.lake import Lake
from cdrlake.workload.queries import duckdb_sql, spark_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = spark_queries(), duckdb_sql()
ROWS_ONLY = {
    "stream_progress", "churn_scores", "top_churn_scores", "score_bands", "churn_band_counts", "churn_metrics",
    "churn_feature_importance", "churn_top_features", "vw_customer_360", "vw_churn_analysis",
    "m_high_churn_count", "m_avg_churn_prob", "sample_scores",
}
# These share one run per session, so they do not go into the pool.
SHARED = {"lake_arpu_monthly", "lake_executive_kpis"}


def test_only_model_and_progress_queries_lack_sql():
    assert QUERIES.keys() - ORACLE.keys() == ROWS_ONLY
    assert ORACLE.keys() <= QUERIES.keys()


def check(spark, con, name):
    try:
        return compare.difference(QUERIES[name](spark, SF_DIR), con.cursor(), ORACLE[name])
    except Exception as e:
        return f"{type(e).__name__}: {str(e)[:500]}"


def test_queries_equal_their_sql(spark):
    con = compare.connect(SF_DIR)
    names = sorted(ORACLE.keys() - SHARED)
    with ThreadPoolExecutor(4) as pool:
        results = dict(zip(names, pool.map(lambda n: check(spark, con, n), names)))
    assert {n: d for n, d in results.items() if d} == {}


def test_whole_run_over_files_equals_the_sql(spark):
    con = compare.connect(SF_DIR)
    assert {n: check(spark, con, n) for n in SHARED} == dict.fromkeys(SHARED)


def test_model_queries_give_rows(spark):
    assert {n: QUERIES[n](spark, SF_DIR).count() > 0 for n in ROWS_ONLY} == dict.fromkeys(ROWS_ONLY, True)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["customer_id", "call_month"] and df.count() > 0


@pytest.mark.parametrize("name", ["arpu", "summary", "regional", "daily", "features", "rule_360"])
def test_plans_have_no_cross_join_and_prune_columns(spark, name):
    plan = getattr(Lake(spark, SF_DIR), name)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoop|PythonUDF|ArrowEval", plan)
    assert "l_linestatus" not in plan and "o_totalprice" not in plan


@pytest.fixture
def shuffled(spark):
    """The exchanges by key of a plan whose tables are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda df: re.findall(r"Exchange hashpartitioning\(([^\n]*), \d+\), (\w+)", df._jdf.queryExecution().executedPlan().toString())
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_move_once_before_duplicates_are_removed(spark, shuffled):
    """They were spread, moved to their orders, and moved once more with all columns to the customers."""
    keys = [k.split("#")[0] for k, _ in shuffled(Lake(spark, SF_DIR).bronze_cdr)]
    assert keys.count("l_orderkey") == 1 and len(keys) - sum(k.startswith(("c_", "n_", "r_")) for k in keys) == 4


def test_usage_stays_in_place_when_joined(spark, shuffled):
    """Usage by customer and month was moved once more for the join with the customers."""
    lake = Lake(spark, SF_DIR)
    usage, arpu = ([k for k, _ in shuffled(df) if k.startswith("customer_id")] for df in (lake.cdr_monthly, lake.arpu))
    assert len(usage) == 2
    # besides: the customers, and the recharges by month and by customer
    assert len(arpu) == 2 + 3


def test_texts_of_landed_cdrs_are_made_after_the_rows_have_moved(spark):
    """CDRs moved to the files of their months as text."""
    lake = Lake(spark, SF_DIR)
    landed = landing._cdrs_by_month(lake, "CAST(right(file, 2) AS INT) % 2 = 1")
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    plan = landed._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    above, below = plan.split("RebalancePartitions", 1)
    assert "CDR" in above and "CDR" not in below
    plain = lake.bronze_cdr.where("substr(call_date, 6, 2) IN ('01', '03', '05', '07', '09', '11', '13')")
    assert plain.count() > 0 and plain.exceptAll(landed.drop("file")).isEmpty() and landed.drop("file").exceptAll(plain).isEmpty()


@pytest.mark.parametrize("name", ["rule_360", "stored_summary", "stored_rule_scores"])
def test_summary_and_scores_come_from_stored_facts(spark, name):
    """The CDRs were worked off once for the summary and once for the features."""
    assert "lineitem" not in getattr(Lake(spark, SF_DIR), name)._jdf.queryExecution().executedPlan().toString()
