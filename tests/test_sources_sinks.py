import datetime as dt
import os

import frames
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cdrlake import schemas
from cdrlake.config import RunConfig
from cdrlake.operators import control
from cdrlake.plans.batch import build_silver, run_batch
from cdrlake.plans.incremental import full_reload_customers, incremental_load
from cdrlake.plans.serving import register_serving_views
from cdrlake.sinks import tables as sinks
from cdrlake.sources import files, tables

HEADER = ",".join(schemas.CDR.names)


def cdr_line(cdr_id, day, revenue="1.5"):
    values = {"cdr_id": cdr_id, "customer_id": "A", "call_date": day, "revenue_qar": revenue, "call_type": "Voice"}
    return ",".join(values.get(c, "") for c in schemas.CDR.names)


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path)


def test_cdr_scan_filters_the_window_and_reads_empty_as_null(spark, lake, rows):
    write(f"{lake}/a.csv", cdr_line("1", "2024-10-01"), cdr_line("2", "2024-10-31"), cdr_line("3", "2024-11-01"))
    df = files.read_cdr(spark, f"{lake}/a.csv", "2024-10-01", "2024-10-31")
    assert df.columns == schemas.CDR.names
    assert rows(df, "cdr_id", "roaming_country") == [("1", None), ("2", None)]


def test_rejected_lines_keep_their_text(spark, lake, rows):
    write(f"{lake}/a.csv", cdr_line("1", "2024-10-01"), cdr_line("2", "2024-10-01", "abc"))
    good, bad = files.read_with_rejects(spark, f"{lake}/a.csv", schemas.CDR)
    assert rows(good, "cdr_id") == [("1",)]
    assert bad.first().line.startswith("2,A")


def test_rejects_name_their_reason(spark, lake, rows):
    write(f"{lake}/a.csv", cdr_line("1", "2024-10-01"), cdr_line("2", "2024-10-01", "abc"), "3,short")
    _, bad = files.read_with_rejects(spark, f"{lake}/a.csv", schemas.CDR)
    assert rows(bad, "reject_reason") == [("fields",), ("revenue_qar",)]


def test_extract_routes_inactive_and_misfits_in_one_pass(spark, lake, rows):
    source = frames.customers(spark, {}, {"customer_id": "B", "is_active": 0}, {"customer_id": "C"})
    source = source.withColumn("age", F.when(F.col("customer_id") == "C", "old").otherwise("30"))
    assert files.extract_active_customers(source, f"{lake}/out") == {"written": 1, "rejected": 1}
    assert rows(files.read_extract(spark, f"{lake}/out"), "customer_id", "plan_type") == [("A", " prepaid")]
    assert rows(files.read_extract(spark, f"{lake}/out", "rejected"), "customer_id", "age") == [("C", "old")]
    staging = files.load_customers_staging(spark, f"{lake}/out/outcome=written")
    assert dict(staging.dtypes)["monthly_fee_qar"] == "decimal(10,2)"
    assert staging.first().activation_date == dt.date(2024, 1, 1)
    nobody = source.where("false")
    assert files.extract_active_customers(nobody, f"{lake}/none") == {"written": 0, "rejected": 0}
    assert files.read_extract(spark, f"{lake}/none").count() == 0


@pytest.mark.parametrize(
    "name,date",
    [("cdrs_2024_10_01.csv", dt.date(2024, 10, 1)), ("cdrs_2024-10-01.csv", dt.date(2024, 10, 1)),
     ("x/cdrs_2024_10/part-0.csv", dt.date(2024, 10, 1)), ("notes.txt", None), ("cdrs_2024_13_01.csv", None)],
)
def test_file_dates(spark, name, date):
    df = spark.createDataFrame([(name,)], "path string")
    assert df.select(files.file_date("path", "cdrs")).first()[0] == date


def test_listing_and_new_files(spark, lake):
    write(f"{lake}/cdrs_2024_10_01.csv", cdr_line("1", "2024-10-01"))
    write(f"{lake}/cdrs_2024-10-02.csv", cdr_line("2", "2024-10-02"))
    write(f"{lake}/notes.txt")
    listing = files.list_files(spark, lake)
    assert listing.count() == 3
    new = files.new_files(listing, "cdrs", F.lit("2024-10-01").cast("timestamp"))
    assert [os.path.basename(r.path) for r in new.collect()] == ["cdrs_2024-10-02.csv"]


def load(spark, lake, marks, **settings):
    return incremental_load(
        spark, f"{lake}/bronze", "cdrs", schemas.CDR, f"{lake}/landing", marks, "cdrs_incremental_load",
        schemas.CDR_COPY_COLUMNS, f"{lake}/audit", **settings,
    )


def new_marks(spark, path):
    marks = control.ControlTable(spark, path)
    marks.init(control.init_watermarks(spark))
    return marks


def watermark(marks, pipeline="cdrs_incremental_load"):
    return control.get_watermark(marks.read(), pipeline).first()[0]


def test_incremental_load_is_incremental(spark, lake, rows):
    marks = new_marks(spark, f"{lake}/marks")
    write(f"{lake}/bronze/cdrs_2024_10_01.csv", cdr_line("1", "2024-10-01"), cdr_line("2", "2024-10-01"))
    write(f"{lake}/bronze/cdrs_2024-10-02.csv", cdr_line("3", "2024-10-02"))
    first = load(spark, lake, marks)
    assert first.rows_written == {"cdrs_incremental_load": 3}
    assert watermark(marks) == dt.datetime(2024, 10, 2)

    again = load(spark, lake, marks)
    assert again.rows_written == {"cdrs_incremental_load": 0}
    assert spark.read.parquet(f"{lake}/landing").count() == 3

    write(f"{lake}/bronze/cdrs_2024_10_03.csv", cdr_line("4", "2024-10-03"))
    write(f"{lake}/bronze/cdrs_2024_09_30.csv", cdr_line("late", "2024-09-30"))
    write(f"{lake}/bronze/cdrs_2024_10_02_b.csv", cdr_line("second", "2024-10-02"))
    # in waves of two; the first file of the second of October is not read again
    third = load(spark, lake, marks, wave=2)
    assert third.rows_written == third.rows_read == {"cdrs_incremental_load": 3} and third.detail["files"] == 3
    landed = spark.read.parquet(f"{lake}/landing")
    assert rows(landed, "cdr_id") == [("1",), ("2",), ("3",), ("4",), ("late",), ("second",)]
    assert watermark(marks) == dt.datetime(2024, 10, 3)
    assert load(spark, lake, marks).rows_written == {"cdrs_incremental_load": 0}
    assert set(landed.columns) == {*schemas.CDR_COPY_COLUMNS, "file_date", "source_file"}
    audit = sinks.read_merged(spark, f"{lake}/audit")
    assert rows(audit.where("rows_written > 0"), "status", "rows_read", "rows_written") == [("SUCCESS", 3, 3)] * 2
    assert audit.count() == 4
    assert os.listdir(f"{lake}/landing_manifest") == ["loaded"]
    others = marks.read().where("pipeline_name <> 'cdrs_incremental_load'")
    assert {r.last_run_status for r in others.collect()} == {"PENDING"}
    with pytest.raises(ValueError):
        incremental_load(spark, lake, "cdrs", schemas.CDR, f"{lake}/x", marks, "unknown")


def test_a_file_that_has_grown_replaces_its_rows(spark, lake, rows):
    marks = new_marks(spark, f"{lake}/marks")
    path = f"{lake}/bronze/cdrs_2024_10_01 [x]{{a}}.csv"  # characters of path patterns
    write(path, cdr_line("1", "2024-10-01"))
    assert load(spark, lake, marks).rows_written == {"cdrs_incremental_load": 1}
    write(path, cdr_line("1", "2024-10-01"), cdr_line("2", "2024-10-01"))
    assert load(spark, lake, marks).rows_written == {"cdrs_incremental_load": 2}
    assert rows(spark.read.parquet(f"{lake}/landing"), "cdr_id") == [("1",), ("2",)]


def test_only_the_new_file_is_read(spark, lake):
    for day in range(1, 29):
        write(f"{lake}/bronze/cdrs_2024_10_{day:02d}.csv", cdr_line(str(day), f"2024-10-{day:02d}"))
    listed = files.list_files(spark, f"{lake}/bronze")
    new = files.new_files(listed, "cdrs", F.lit("2024-10-27").cast("timestamp")).collect()
    read = files.read_listed(spark, [f["path"] for f in new], "cdrs", schemas.CDR)
    assert [os.path.basename(p) for p in read.inputFiles()] == ["cdrs_2024_10_28.csv"]
    marks = new_marks(spark, f"{lake}/marks")
    assert load(spark, lake, marks).rows_read == {"cdrs_incremental_load": 28}
    write(f"{lake}/bronze/cdrs_2024_10_28_b.csv", cdr_line("b", "2024-10-28"))
    assert load(spark, lake, marks).rows_read == {"cdrs_incremental_load": 1}


def test_misfits_are_counted_and_kept(spark, lake, rows):
    marks = new_marks(spark, f"{lake}/marks")
    write(f"{lake}/bronze/cdrs_2024_10_01.csv", cdr_line("1", "2024-10-01"), cdr_line("2", "2024-10-01", "abc"), "3,short")
    result = load(spark, lake, marks)
    assert (result.rows_read, result.rows_written) == ({"cdrs_incremental_load": 3}, {"cdrs_incremental_load": 1})
    assert result.quality == {"rejected_revenue_qar": 1, "rejected_fields": 1}
    bad = spark.read.parquet(f"{lake}/landing_rejects")
    assert rows(bad, "reject_reason") == [("fields",), ("revenue_qar",)]
    assert rows(spark.read.parquet(f"{lake}/landing"), "cdr_id") == [("1",)]


def test_a_failed_load_leaves_its_row_and_the_watermark(spark, lake, rows):
    marks = new_marks(spark, f"{lake}/marks")
    with pytest.raises(AnalysisException):
        load(spark, lake, marks)  # there is no folder yet
    row = sinks.read_merged(spark, f"{lake}/audit").first()
    assert (row.status, row.rows_read, row.rows_written) == ("FAILED", 0, 0) and "bronze" in row.error_message
    state = marks.read().where("pipeline_name = 'cdrs_incremental_load'").first()
    assert state.last_run_status == "FAILED" and state.last_watermark == dt.datetime(2000, 1, 1)


def test_two_loads_that_overlap_keep_both_moves(spark, lake):
    a, b = new_marks(spark, f"{lake}/marks"), control.ControlTable(spark, f"{lake}/marks")
    before = b.read().collect()
    a.move("cdrs_incremental_load", dt.datetime(2024, 10, 2), "SUCCESS", 5)
    # the other load read the table before that move
    assert len(before) == 3
    b.move("recharges_incremental", dt.datetime(2024, 9, 1), "SUCCESS", 7)
    assert watermark(a) == dt.datetime(2024, 10, 2) and watermark(b, "recharges_incremental") == dt.datetime(2024, 9, 1)
    # two of one pipeline with the same version: the one further on counts
    own = a.read().where("pipeline_name = 'customers_full_load'").withColumn("version", F.lit(9).cast("bigint"))
    for day in (3, 1):
        a._append(own.withColumn("last_watermark", F.lit(f"2024-11-0{day}").cast("timestamp")))
    assert watermark(a, "customers_full_load") == dt.datetime(2024, 11, 3)


def test_loads_at_the_same_time(spark, lake):
    marks = new_marks(spark, f"{lake}/marks")
    sinks.together({
        p: lambda p=p, n=n: control.ControlTable(spark, f"{lake}/marks").move(p, dt.datetime(2024, 1, n), "SUCCESS", n)
        for n, p in enumerate(control.PIPELINES, 1)
    })
    assert {(r.pipeline_name, r.last_run_rows) for r in marks.read().collect()} == {(p, n) for n, p in enumerate(control.PIPELINES, 1)}


def test_full_reload_records_the_rows(spark, lake):
    marks = new_marks(spark, f"{lake}/marks")
    source = frames.customers(spark, {}, {"customer_id": "B", "is_active": 0})
    assert full_reload_customers(source, f"{lake}/out", marks).rows_written == {"customers_full_load": 1}
    row = marks.read().where("pipeline_name = 'customers_full_load'").first()
    assert (row.last_run_status, row.last_run_rows) == ("SUCCESS", 1)


def test_update_of_an_unknown_pipeline_changes_nothing(spark, rows):
    marks = control.init_watermarks(spark)
    now = dt.datetime(2024, 1, 1)
    loads = spark.createDataFrame([("x", now, "SUCCESS", 1)], control.LOADS)
    assert rows(control.moved(marks, loads, now)) == rows(marks)
    assert marks.count() == 3 and control.get_watermark(marks, "x").count() == 0


def test_partitioned_overwrite_static_and_dynamic(spark, lake, rows):
    a = spark.createDataFrame([(1, "2024-10"), (2, "2024-11")], "v int, call_month string")
    b = spark.createDataFrame([(3, "2024-11")], "v int, call_month string")
    path = f"{lake}/silver/t"
    assert sinks.write_table(a, path, "call_month") == 2
    assert sinks.write_table(b, path, "call_month", dynamic=True) == 1  # what was written, not what is there
    assert rows(tables.read_table(spark, lake, "silver", "t")) == [(1, "2024-10"), (3, "2024-11")]
    assert sinks.write_table(b, path, "call_month") == 1


def test_a_failed_replacement_leaves_the_table(spark, lake):
    path = f"{lake}/gold/t"
    sinks.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string"), path, "k")
    bad = spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.lit("z")).alias("k"), "id")
    with pytest.raises(Exception, match="lost"):
        sinks.write_table(bad, path, "k")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]
    assert os.listdir(f"{lake}/gold") == ["t"]


def test_a_table_is_replaced_by_rows_of_its_own(spark, lake):
    path = f"{lake}/t"
    sinks.write_table(spark.range(5), path)
    table = spark.read.parquet(path)
    assert sinks.write_table(table.where("id > 2"), path) == 2
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 4]
    assert os.listdir(lake) == ["t"]


@pytest.mark.parametrize("complete", [False, True])
def test_a_replacement_cut_off_half_way_is_settled(spark, lake, complete):
    path, old = f"{lake}/t", f"{lake}/_old-t"
    sinks.write_table(spark.range(5), path)
    os.rename(path, old)
    if complete:
        spark.range(7).write.parquet(path)
    sinks.settle(spark, path)
    assert spark.read.parquet(path).count() == (7 if complete else 5) and os.listdir(lake) == ["t"]


def test_columns_in_another_order_are_an_error(spark, lake):
    names = [*schemas.CDR.names[1:], schemas.CDR.names[0]]
    with open(f"{lake}/swapped.csv", "w") as f:
        f.write(",".join(names) + "\n" + cdr_line("1", "2024-10-01") + "\n")
    for read in (lambda: files.read_cdr(spark, f"{lake}/swapped.csv", "2024-01-01", "2024-12-31"), lambda: files.read_with_rejects(spark, f"{lake}/swapped.csv", schemas.CDR)[0]):
        with pytest.raises(Exception, match="(?i)header"):
            read().collect()


def test_run_parameters(spark, lake, caplog):
    cfg = RunConfig(lake + "/{env}", "2024-10-01", "2024-12-31", env="test", source_folder="raw", sink_folder="typed", debug=True)
    cdrs = frames.cdr(spark, {}, {"cdr_id": "2", "call_date": None}, {"cdr_id": "3", "call_date": "2023-01-01"})
    sinks.write_csv(cdrs, f"{lake}/test/raw/cdrs")
    sinks.write_csv(frames.customers(spark, {}), f"{lake}/test/raw/customers")
    sinks.write_csv(frames.recharges(spark, {}), f"{lake}/test/raw/recharges")
    with caplog.at_level("INFO", logger="cdrlake"):
        result = run_batch(spark, cfg)
    assert result.quality["null_call_date"] == 1 and result.rows_written["cdrs"] == 1
    assert sorted(n for n in os.listdir(f"{lake}/test") if n != "silver") == ["control", "gold", "raw", "typed", "work"]
    assert not os.path.exists(f"{lake}/test/silver")
    assert "batch rows_written cdrs: 1" in caplog.messages
    with pytest.raises(ValueError, match="env"):
        RunConfig(lake, env="staging")


def test_appends_merge_new_columns(spark, lake, rows):
    sinks.append_merge(spark.createDataFrame([(1,)], "a int"), f"{lake}/t")
    sinks.append_merge(spark.createDataFrame([(2, "x")], "a int, b string"), f"{lake}/t")
    assert rows(sinks.read_merged(spark, f"{lake}/t"), "a", "b") == [(1, None), (2, "x")]
    assert sinks.compact(spark, f"{lake}/t", f"{lake}/compacted") == 2


def test_clustering_splits_a_hot_value(spark, lake):
    hot = spark.range(4000).select(
        F.when(F.col("id") < 3000, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("customer_id"),
        F.lit("2024-10-01").alias("call_date"),
        F.col("id").cast("string").alias("cdr_id"),
    )
    out = sinks.cluster_for_read(hot, ["customer_id", "call_date"], "cdr_id", 8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1500


def test_catalog_registration(spark, lake):
    sinks.publish_gold(lake, {"t": (spark.createDataFrame([(1, "2024-10")], "v int, call_month string"), "call_month")})
    for _ in range(2):
        sinks.register_catalog(spark, "cdr_gold_test", lake, ["t"], location=f"{lake}/db")
    assert spark.sql("SELECT v, call_month FROM cdr_gold_test.t").collect() == [(1, "2024-10")]
    spark.sql("DROP DATABASE cdr_gold_test CASCADE")


def test_a_window_run_keeps_the_other_days_of_its_months(spark, lake):
    cfg = RunConfig(lake, "2024-10-01", "2024-10-31")
    days = [{"cdr_id": str(d), "call_date": f"2024-10-{d:02d}"} for d in range(1, 29)]
    sinks.write_csv(frames.cdr(spark, *days), cfg.bronze("cdrs"))
    sinks.write_csv(frames.customers(spark, {}), cfg.bronze("customers"))
    sinks.write_csv(frames.recharges(spark, {}), cfg.bronze("recharges"))
    build_silver(spark, cfg)
    build_silver(spark, RunConfig(lake, "2024-10-05", "2024-10-06"), dynamic=True)
    assert tables.read_table(spark, lake, "silver", "cdrs").count() == 28


def test_an_empty_window_is_no_error(spark, lake):
    cfg = RunConfig(lake, "2030-01-01", "2030-01-02")
    sinks.write_csv(frames.cdr(spark, {}), cfg.bronze("cdrs"))
    sinks.write_csv(frames.customers(spark, {}), cfg.bronze("customers"))
    sinks.write_csv(frames.recharges(spark, {}), cfg.bronze("recharges"))
    result = build_silver(spark, cfg)
    assert result.rows_written["cdrs"] == 0 and result.rows_read["customers"] == 1


def test_batch_run_and_serving_views(spark, lake):
    cfg = RunConfig(lake, "2024-10-01", "2024-12-31", database="cdr_gold_run")
    sinks.write_csv(
        frames.cdr(spark, {}, {}, {"cdr_id": "2", "customer_id": None}, {"cdr_id": "3", "call_date": "2024-12-01"}, {"cdr_id": "old", "call_date": "2024-01-01"}),
        cfg.bronze("cdrs"),
    )
    sinks.write_csv(frames.customers(spark, {}), cfg.bronze("customers"))
    sinks.write_csv(frames.recharges(spark, {}), cfg.bronze("recharges"))
    result = run_batch(spark, cfg)
    assert result.rows_read == {"cdrs": 4, "customers": 1, "recharges": 1}
    assert result.quality["null_customer_id"] == 1
    assert result.rows_written == {
        "cdrs": 2, "customers": 1, "recharges": 1, "usage_daily": 2, "arpu_monthly": 2, "customer_summary": 1,
        "regional_kpis": 1, "daily_trend": 2,
    }
    assert spark.table("cdr_gold_run.arpu_monthly").count() == 2
    assert result.quality["rejected_cdrs"] == 1
    assert tables.read_table(spark, lake, "silver", "cdrs_rejects").first().reject_reason == "no customer_id"
    run = sinks.read_merged(spark, f"{lake}/control/audit").first()
    assert (run.pipeline_name, run.status, run.rows_read) == ("batch", "SUCCESS", 6)
    register_serving_views(spark, lake, with_scores=False)
    assert spark.sql("SELECT total_customers FROM vw_executive_kpis").first()[0] == 1
    assert spark.sql("SELECT * FROM vw_arpu_monthly_trend WHERE call_month = '2024-12'").count() == 1
    spark.sql("DROP DATABASE cdr_gold_run CASCADE")
