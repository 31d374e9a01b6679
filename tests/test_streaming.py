import json
import os

import pytest
from pyspark.sql import functions as F

from cdrlake.sinks.tables import read_merged
from cdrlake.streaming import alerts, batches, events, progress, run, windows
from cdrlake.workload.queries import BATCH_FILES, FILE_MESSAGES, capture_layout


def event(i, **changes):
    base = {
        "event_id": f"E{i}", "event_type": "call_dropped", "customer_id": "A", "msisdn": "1",
        "event_time": "2024-10-01T10:00:00Z", "churn_risk": "High", "region": "Doha", "segment": "VIP",
        "plan_name": "P", "duration_seconds": 5,
    }
    return json.dumps({k: v for k, v in (base | changes).items() if v is not None})


LINES = [
    event(1),
    event(2, event_type="data_session_end", data_mb=1.5),
    event(3, churn_risk="Low"),
    event(4, event_type="sms_sent", duration_seconds=None),
    event(5, event_id=None),
    event(6, customer_id=None),
    "not json",
    event(7, event_time="2023-01-01T00:00:00Z"),  # far behind the watermark, still kept
    event(1),
]


@pytest.fixture
def capture(spark, tmp_path):
    """A folder of JSON line files."""
    folder = tmp_path / "in"
    os.makedirs(folder)
    for i in range(3):
        (folder / f"{i}.json").write_text("\n".join(LINES[i::3]) + "\n")
    return str(folder)


def batch(spark, folder):
    raw = spark.read.text(folder).select(
        F.col("value").cast("binary").alias("body"),
        F.current_timestamp().alias("enqueuedTime"),
        F.lit(0).alias("partition"),
        F.lit("0").alias("offset"),
    )
    return events.parse_events(raw)


def drain(raw, base):
    queries = run.run_streams(raw, base, trigger=None)
    for q in queries:
        q.awaitTermination()
    return queries


KEYS = ["event_id", "event_type", "event_time", "data_mb", "duration_seconds", "is_dropped", "is_recharge",
        "is_data_event", "is_high_churn_customer"]


def test_stream_equals_batch_and_restarts_add_nothing(spark, capture, tmp_path, rows):
    base = str(tmp_path / "lake")
    want = rows(events.silver_events(batch(spark, capture)), *KEYS)
    assert len(want) == 6
    queries = drain(events.read_json_lines(spark, capture, max_files=1), base)
    assert rows(spark.read.parquet(f"{base}/silver/events"), *KEYS) == want
    progress = run.progress_rows(spark, *queries)
    assert progress.where("query = 'silver_events'").agg(F.sum("input_rows")).first()[0] == len(LINES)
    got_alerts = spark.read.parquet(f"{base}/gold/realtime_alerts")
    # a folder for each checkpoint, so that another one leaves earlier alerts alone
    assert {len(r["query"]) for r in got_alerts.select("query").distinct().collect()} == {36}
    assert got_alerts.count() == 4  # E1 twice, E2 and E7
    assert {r.alert_type for r in got_alerts.collect()} == {"CHURN_RISK_ACTIVITY"}

    drain(events.read_json_lines(spark, capture, max_files=1), base)
    assert spark.read.parquet(f"{base}/silver/events").count() == len(want)
    assert spark.read.parquet(f"{base}/gold/realtime_alerts").count() == 4

    (tmp_path / "in" / "new.json").write_text(event(8) + "\n")
    drain(events.read_json_lines(spark, capture, max_files=1), base)
    assert spark.read.parquet(f"{base}/silver/events").count() == len(want) + 1


def test_replayed_and_empty_batches(spark, capture, tmp_path):
    out = str(tmp_path / "alerts")
    write = alerts.alert_writer(out)
    silver = events.silver_events(batch(spark, capture))
    write(silver, 0)
    write(silver, 0)
    write(silver.where("false"), 1)
    got = spark.read.parquet(out)
    assert got.count() == 4 and {r.batch_id for r in got.collect()} == {0}


def test_bad_events_complete_the_silver_rows(spark, capture):
    parsed = batch(spark, capture)
    assert events.bad_events(parsed).count() == 3
    assert events.silver_events(parsed).count() + events.bad_events(parsed).count() == len(LINES)


def test_enrichment_replaces_attributes(spark, capture, rows):
    customers = spark.createDataFrame(
        [("A", "Mid Value", "New plan", "Low", "Lusail")],
        "customer_id string, segment string, plan_name string, churn_risk string, region string",
    )
    got = events.enrich_events(events.silver_events(batch(spark, capture)), customers)
    assert set(rows(got, "segment", "plan_name", "churn_risk", "region")) == {("Mid Value", "New plan", "Low", "Lusail")}


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="kafka"):
        events.read_kafka(spark, "localhost:1", "t")


CUSTOMER = "customer_id string, segment string, plan_name string, churn_risk string, region string"


def lookup(spark, capture, base, name="lookup"):
    query = batches.start_event_stream(
        events.read_json_lines(spark, capture, max_files=1), f"{base}/good", f"{base}/bad", f"{base}/check",
        lambda: spark.read.schema(CUSTOMER).parquet(f"{base}/customers"), None, name,
    )
    query.awaitTermination()


def test_a_changed_customer_is_seen_by_the_next_batch(spark, capture, tmp_path, rows):
    base = str(tmp_path / "lake")
    spark.createDataFrame([("A", "Mid Value", "Old", "Low", "Lusail")], CUSTOMER).write.parquet(f"{base}/customers")
    lookup(spark, capture, base)
    assert set(rows(spark.read.parquet(f"{base}/good"), "plan_name")) == {("Old",)}
    spark.createDataFrame([("A", "VIP", "New", "Low", "Lusail")], CUSTOMER).write.mode("overwrite").parquet(f"{base}/customers")
    (tmp_path / "in" / "later.json").write_text(event(20) + "\n" + event(21, customer_id="unknown") + "\n")
    lookup(spark, capture, base)
    got = spark.read.parquet(f"{base}/good")
    assert rows(got.where("event_id in ('E20', 'E21')"), "event_id", "plan_name", "segment") == [("E20", "New", "VIP"), ("E21", None, None)]
    assert got.where("event_id not in ('E20', 'E21')").count() == 6


def test_good_and_dead_letters_of_a_replayed_batch(spark, capture, tmp_path, rows):
    raw = spark.read.text(capture).select(
        F.col("value").cast("binary").alias("body"), F.current_timestamp().alias("enqueuedTime"), F.lit(0).alias("partition"), F.lit("0").alias("offset")
    )
    write = batches.event_writer(f"{tmp_path}/good", f"{tmp_path}/bad")
    for _ in range(2):
        write(raw, 0)
    write(raw.where("false"), 1)
    bad = spark.read.parquet(f"{tmp_path}/bad")
    assert rows(bad, "event_id", "reason") == [("E6", "no customer_id"), (None, "no event_id"), (None, "unreadable")]
    assert "not json" in {r.body for r in bad.collect()}
    assert spark.read.parquet(f"{tmp_path}/good").count() == 6


def test_repeated_and_late_events_in_windows(spark, tmp_path, rows):
    folder = tmp_path / "in"
    os.makedirs(folder)

    def run_with(name, *lines):
        (folder / name).write_text("\n".join(lines) + "\n")
        raw = events.read_json_lines(spark, str(folder))
        query = windows.start_window_stream(raw, f"{tmp_path}/out", f"{tmp_path}/check", None, name=name)
        query.awaitTermination()
        return query

    def at(i, time, **changes):
        return event(i, event_time=f"2024-10-01T{time}:00Z", **changes)

    run_with("a", at(1, "10:05"), at(1, "10:05"), at(2, "10:20"), at(3, "11:02"))
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == []  # 11:02 less ten minutes has not passed 11:00
    # E2 again and a late but not too late one; 12:15 ends the hours before 12
    run_with("b", at(2, "10:20"), at(4, "10:55"), at(5, "12:15"))
    query = run_with("c", at(6, "10:58"), at(7, "14:00"))  # 10:58 is too late now
    got = spark.read.parquet(f"{tmp_path}/out")
    assert [(r.window_start.hour, r.events, r.dropped) for r in got.orderBy("window_start").collect()] == [(10, 3, 3), (11, 1, 1), (12, 1, 1)]
    late = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert late >= 1
    assert windows.window_counts(windows.once(events.silver_events(batch(spark, str(folder))))).agg(F.sum("events")).first()[0] == 7


def test_the_listener_writes_every_batch(spark, capture, tmp_path):
    log = progress.ProgressLog(spark, f"{tmp_path}/progress")
    queries = drain(events.read_json_lines(spark, capture, max_files=1), str(tmp_path / "lake"))
    log.close(*queries)
    rows = read_merged(spark, f"{tmp_path}/progress")
    assert {(r["query"], r.input_rows) for r in progress.progress_totals(rows).collect()} == {("silver_events", len(LINES)), ("churn_alerts", len(LINES))}
    # three files each, and a closing batch of the stateless silver query may follow
    assert rows.where("input_rows > 0").count() == 6 and rows.where("watermark is not null").count() >= 3


def test_captured_files_grow_in_number_not_in_size():
    """There were four files however many messages came, each written by one task."""
    assert [capture_layout(n) for n in (0, 1_000, 200_000)] == [(4, 2)] * 3
    parts, batch = capture_layout(36_000_000)
    assert 36_000_000 / parts <= FILE_MESSAGES and batch == BATCH_FILES
