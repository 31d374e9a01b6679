"""Micro-batches with several outputs under one checkpoint."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .events import TRIGGER, _timed, dead_letters, enrich_events, parse_events, silver_events


def batch_folder(batch: DataFrame, path: str, batch_id: int) -> str:
    """The folder that a batch owns.  It is overwritten, so a replayed batch leaves the same rows;
    the query's id is that of its checkpoint, so that another one leaves earlier rows alone."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    return f"{path}/query={query}/batch_id={batch_id}"


def event_writer(good: str, bad: str, customers: Callable[[], DataFrame] | None = None):
    """The micro-batch function over raw messages: Silver events to ``good``, the others to ``bad``.

    ``customers`` is called for every batch; the frame it returns is read anew, so a
    changed customer is seen by the next batch.  Both outputs of a batch are written
    before the checkpoint counts it as done, and each is overwritten when it is replayed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_events(batch, keep_body=True).persist()  # one micro-batch, parsed once
        try:
            events = silver_events(parsed.drop("body"))
            if customers is not None:
                events = enrich_events(events, customers())
            stamped = events.withColumn("silver_load_dttm", F.current_timestamp())
            stamped.write.mode("overwrite").parquet(batch_folder(batch, good, batch_id))
            dead_letters(parsed).write.mode("overwrite").parquet(batch_folder(batch, bad, batch_id))
        finally:
            parsed.unpersist()

    return write


def start_event_stream(
    raw: DataFrame,
    good: str,
    bad: str,
    checkpoint: str,
    customers: Callable[[], DataFrame] | None = None,
    trigger: str | None = TRIGGER,
    name: str = "events_with_lookup",
) -> StreamingQuery:
    """Events with the customers' present attributes, and dead letters, from one pass over the messages."""
    writer = raw.writeStream.queryName(name).foreachBatch(event_writer(good, bad, customers))
    return _timed(writer.option("checkpointLocation", checkpoint), trigger).start()
