"""The two event queries of the lake, and their progress."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .alerts import start_alert_stream
from .events import TRIGGER, silver_stream, start_silver_stream

PROGRESS = (
    "query string, batch_id bigint, input_rows bigint, input_rows_per_second double,"
    " processed_rows_per_second double, batch_ms bigint"
)


def run_streams(raw: DataFrame, base: str, trigger: str | None = TRIGGER) -> list[StreamingQuery]:
    """Silver append and churn alerts over one source, each with its own checkpoint."""
    rows = silver_stream(raw)
    return [
        start_silver_stream(rows, f"{base}/silver/events", f"{base}/checkpoints/events", trigger),
        start_alert_stream(rows, f"{base}/gold/realtime_alerts", f"{base}/checkpoints/alerts", trigger),
    ]


def progress_rows(spark: SparkSession, *queries: StreamingQuery) -> DataFrame:
    """The recent micro-batches of the queries, one row each."""
    rows = [
        (
            q.name,
            p["batchId"],
            p["numInputRows"],
            float(p.get("inputRowsPerSecond") or 0.0),
            float(p.get("processedRowsPerSecond") or 0.0),
            p.get("batchDuration"),
        )
        for q in queries
        for p in q.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS)
