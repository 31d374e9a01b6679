"""Churn alerts per micro-batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.filters import alert_predicate
from .batches import batch_folder
from .events import TRIGGER, _timed

# Columns and tag of an alert.
ALERT_COLUMNS = [
    "customer_id", "msisdn", "event_type", "event_time", "region", "segment", "plan_name",
    "churn_risk", "enqueued_time",
]
ALERT_TYPE = "CHURN_RISK_ACTIVITY"


def churn_alerts(events: DataFrame) -> DataFrame:
    tagged = events.where(alert_predicate()).select(*ALERT_COLUMNS)
    return tagged.withColumn("alert_type", F.lit(ALERT_TYPE))


def alert_writer(path: str):
    """The micro-batch function; a batch without alerts writes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        alerts = churn_alerts(batch).withColumn("alert_created", F.current_timestamp()).persist()
        try:
            if not alerts.isEmpty():
                alerts.write.mode("overwrite").parquet(batch_folder(batch, path, batch_id))
        finally:
            alerts.unpersist()

    return write


def start_alert_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    name: str = "churn_alerts",
) -> StreamingQuery:
    writer = (
        df.writeStream.queryName(name)
        .foreachBatch(alert_writer(path))
        .option("checkpointLocation", checkpoint)
    )
    return _timed(writer, trigger).start()
