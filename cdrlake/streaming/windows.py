"""Stateful steps behind the event-time watermark: repeated messages and counts per time window.

Both keep state only as long as the watermark asks for: an event's id until events of its
time are too late, a window's counts until the window is complete.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .events import TRIGGER, WATERMARK, _timed, parse_events, silver_events, with_event_time

WINDOW = "1 hour"


def once(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Each event once, though the broker may send it again within the watermark's delay.

    Events without a time have no place in any window and are left out; in a stream, so are
    events that are later than the watermark allows.
    """
    timed = with_event_time(events.where(F.col("event_time").isNotNull()), delay)
    return timed.dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else timed.dropDuplicates(["event_id"])


def window_counts(events: DataFrame, window: str = WINDOW) -> DataFrame:
    """Events, drops and recharged amount per time window and event type."""
    return (
        events.groupBy(F.window("event_time", window).alias("w"), "event_type")
        .agg(
            F.count("*").alias("events"),
            F.sum("is_dropped").alias("dropped"),
            F.sum(F.col("recharge_amount").cast("decimal(12,2)")).cast("decimal(24,2)").alias("recharged"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "events", "dropped", "recharged")
    )


def start_window_stream(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    window: str = WINDOW,
    delay: str = WATERMARK,
    name: str = "event_windows",
) -> StreamingQuery:
    """Append the counts of each window once, when the watermark has passed its end."""
    counts = window_counts(once(silver_events(parse_events(raw)), delay), window)
    writer = counts.writeStream.queryName(name).format("parquet").outputMode("append")
    return _timed(writer.option("checkpointLocation", checkpoint), trigger).start(path)
