"""Progress of streaming queries, written by a listener as it happens."""

import json
import queue
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sinks.tables import append_merge

PROGRESS_LOG = (
    "query string, query_id string, run_id string, batch_id bigint, at string, input_rows bigint,"
    " input_rows_per_second double, processed_rows_per_second double, batch_ms bigint, watermark string,"
    " state_rows bigint, late_rows bigint"
)


class ProgressLog(StreamingQueryListener):
    """Appends one row for every micro-batch of every query of the session to a table.

    A query keeps only its last hundred batches in memory; this keeps all of them.  Spark's
    listener thread only hands the rows over; a thread of the log writes what has come
    together.  Use it in a ``with`` block, or call :meth:`close`.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path
        self.waiting: queue.Queue = queue.Queue()
        self.ended: set[str] = set()
        self.changed = threading.Condition()
        self.failure: Exception | None = None
        self.writer = threading.Thread(target=self._write, daemon=True)
        self.writer.start()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        states = p.get("stateOperators") or []
        self.waiting.put(
            (
                p.get("name"), p["id"], p["runId"], p["batchId"], p["timestamp"], p["numInputRows"],
                float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0), p.get("batchDuration"),
                (p.get("eventTime") or {}).get("watermark"),
                sum(s.get("numRowsTotal", 0) for s in states), sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
            )
        )

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def _write(self) -> None:
        while True:
            rows = [self.waiting.get()]
            while not self.waiting.empty():
                rows.append(self.waiting.get())
            found = [r for r in rows if r is not None]
            try:
                if found:
                    append_merge(self.spark.createDataFrame(found, PROGRESS_LOG).coalesce(1), self.path)
            except Exception as e:  # told by close()
                self.failure = e
            if None in rows:
                return

    def close(self, *queries: StreamingQuery, timeout: float = 60.0) -> None:
        """Wait until the given ended queries have told all of their batches, and write them."""
        runs = {str(q.runId) for q in queries}
        with self.changed:
            self.changed.wait_for(lambda: runs <= self.ended, timeout)
        self.spark.streams.removeListener(self)
        self.waiting.put(None)
        self.writer.join()
        if self.failure is not None:
            raise self.failure


def progress_totals(log: DataFrame) -> DataFrame:
    """Rows read, and rows that came too late, per query."""
    return log.groupBy("query").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))
