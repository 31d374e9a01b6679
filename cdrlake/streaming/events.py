"""Network events: decode, enrich and append to Silver.

The transformations are plain DataFrame functions and serve batch and stream.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import casting as C
from ..functions import codes as K
from ..operators.filters import require

# Schema of captured broker messages.
MESSAGE = "body binary, enqueuedTime timestamp, partition int, offset string"
WATERMARK = "10 minutes"
TRIGGER = "30 seconds"
# Fixed value: events per trigger of a source that is held back; pass it where the sink needs that.
MAX_EVENTS = 1000


def read_capture(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Stream over Parquet files of captured messages."""
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", max_files).parquet(path)


def read_json_lines(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Stream over text files with one JSON event per line.

    The file stands in for the broker: its time is the enqueued time and its name
    the offset.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return lines.select(
        F.col("value").cast("binary").alias("body"),
        F.col("_metadata.file_modification_time").alias("enqueuedTime"),
        F.lit(0).alias("partition"),
        F.col("_metadata.file_name").alias("offset"),
    )


def read_kafka(spark: SparkSession, servers: str, topic: str, max_events: int | None = None, **options) -> DataFrame:
    """Stream over a broker topic from its earliest offset; needs the Kafka package.

    ``max_events`` bounds the offsets of a trigger; without it a trigger takes what there is.
    """
    limit = {} if max_events is None else {"maxOffsetsPerTrigger": max_events}
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**limit, **options)
        .load()
    )
    return stream.select(
        F.col("value").alias("body"),
        F.col("timestamp").alias("enqueuedTime"),
        "partition",
        F.col("offset").cast("string").alias("offset"),
    )


def parse_events(raw: DataFrame, schema: StructType = schemas.EVENT, keep_body: bool = False) -> DataFrame:
    """JSON bytes to columns; a body that is not JSON gives NULL fields.  ``keep_body`` keeps it as text."""
    data = F.from_json(F.col("body").cast("string"), schema)
    return raw.select(
        data.alias("data"),
        F.col("enqueuedTime").alias("enqueued_time"),
        F.col("partition").cast("string").alias("eh_partition"),
        F.col("offset").alias("eh_offset"),
        *([F.col("body").cast("string").alias("body")] if keep_body else []),
    ).select("data.*", "enqueued_time", "eh_partition", "eh_offset", *(["body"] if keep_body else []))


def event_flags(df: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return df.withColumns(
        {
            "is_dropped": K.flag(kind == "call_dropped"),
            "is_recharge": K.flag(kind == "recharge_completed"),
            "is_data_event": K.flag(kind.isin(K.DATA_EVENTS)),
            "is_high_churn_customer": K.flag(F.col("churn_risk") == "High"),
        }
    )


def silver_events(parsed: DataFrame) -> DataFrame:
    """Typed and flagged events that name an event and a customer."""
    typed = parsed.withColumns(
        {
            "event_time": C.to_ts("event_time", C.EVENT_FORMAT),
            "data_mb": C.zero_if_null("data_mb", 0.0),
            "duration_seconds": C.zero_if_null("duration_seconds", 0),
        }
    )
    return require(event_flags(typed), "event_id", "customer_id")


def bad_events(parsed: DataFrame) -> DataFrame:
    """The rows :func:`silver_events` leaves out, for a side table."""
    return parsed.where(F.col("event_id").isNull() | F.col("customer_id").isNull())


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The rows :func:`silver_events` leaves out, with the reason and the message as it came.

    ``parsed`` comes from :func:`parse_events` with ``keep_body``."""
    named = F.coalesce(*[F.col(f.name).cast("string") for f in schemas.EVENT.fields])
    reason = F.when(named.isNull(), "unreadable").when(F.col("event_id").isNull(), "no event_id").otherwise("no customer_id")
    return bad_events(parsed).select("event_id", "eh_partition", "eh_offset", "enqueued_time", reason.alias("reason"), "body")


def enrich_events(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Lookup of customer attributes by customer.

    The customers have one row each, and Spark broadcasts them when their size allows.
    :func:`cdrlake.streaming.batches.start_event_stream` reads them again for every batch.
    """
    names = ["segment", "plan_name", "churn_risk", "region"]
    known = customers.select("customer_id", *[F.col(n).alias(f"known_{n}") for n in names])
    joined = events.join(known, "customer_id", "left")
    return joined.withColumns({n: F.col(f"known_{n}") for n in names}).drop(*[f"known_{n}" for n in names])


def with_event_time(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Watermark on the event time.  It drops nothing by itself; the steps of :mod:`.windows` use it."""
    return df.withWatermark("event_time", delay)


def silver_stream(raw: DataFrame) -> DataFrame:
    rows = silver_events(parse_events(raw)).withColumn("silver_load_dttm", F.current_timestamp())
    return with_event_time(rows)


def start_silver_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    name: str = "silver_events",
) -> StreamingQuery:
    """Append to Parquet; ``trigger=None`` processes what is there and stops."""
    writer = (
        df.writeStream.queryName(name)
        .format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return _timed(writer, trigger).start(path)


def _timed(writer, trigger: str | None):
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
