"""Watermarks and audit rows of the load pipelines."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# Pipelines and the watermark they start from.
PIPELINES = ["customers_full_load", "cdrs_incremental_load", "recharges_incremental"]
EPOCH = "2000-01-01 00:00:00"


def init_watermarks(spark: SparkSession) -> DataFrame:
    names = spark.createDataFrame([(name,) for name in PIPELINES], "pipeline_name string")
    values = {
        "last_watermark": F.lit(EPOCH),
        "last_run_status": F.lit("PENDING"),
        "last_run_rows": F.lit(0),
        "last_run_dttm": F.lit(None),
        "updated_at": F.lit(None),
    }
    kinds = {f.name: f.dataType for f in schemas.WATERMARK.fields}
    return names.select("pipeline_name", *[v.cast(kinds[c]).alias(c) for c, v in values.items()])


def get_watermark(watermarks: DataFrame, pipeline: str) -> DataFrame:
    """One row with ``last_watermark``; no row for an unknown pipeline."""
    return watermarks.where(F.col("pipeline_name") == pipeline).select("last_watermark")


def moved(watermarks: DataFrame, loads: DataFrame, at=None) -> DataFrame:
    """The table after loads (pipeline_name, watermark, status, rows); other rows stay as they are.

    A load without a watermark of its own, such as a failed one, leaves the last one in place.
    """
    now = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    ran = F.col("__status").isNotNull()
    mine = loads.select(
        "pipeline_name", F.col("watermark").cast("timestamp").alias("__watermark"), F.col("status").alias("__status"),
        F.col("rows").cast("bigint").alias("__rows"),
    )
    return watermarks.join(mine, "pipeline_name", "left").select(
        "pipeline_name",
        F.coalesce("__watermark", "last_watermark").alias("last_watermark"),
        F.coalesce("__status", "last_run_status").alias("last_run_status"),
        F.coalesce("__rows", "last_run_rows").alias("last_run_rows"),
        F.when(ran, now).otherwise(F.col("last_run_dttm")).alias("last_run_dttm"),
        F.when(ran, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


LOADS = "pipeline_name string, watermark timestamp, status string, rows bigint"


def audit_row(
    spark: SparkSession, pipeline: str, run_id: str, status: str, rows_read: int,
    rows_written: int, start: datetime, end: datetime, error: str | None = None,
) -> DataFrame:
    audit_id = int(end.timestamp() * 1_000_000)
    row = (audit_id, pipeline, run_id, status, rows_read, rows_written, start, end, error, end)
    return spark.createDataFrame([row], schemas.AUDIT)


class ControlTable:
    """The watermarks, a folder for each pipeline that its own loads alone write to.

    Every move appends one row with the pipeline's next version, and the state is the row
    of the highest version of each; of two loads of one pipeline that ended with the same
    version, the one further on counts.  Nothing is overwritten, so loads of different
    pipelines cannot lose each other's moves, and a failed write leaves the last state.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def init(self, rows: DataFrame) -> None:
        """Write the first state of the pipelines."""
        self._append(rows.withColumn("version", F.lit(0).cast("bigint")))

    def _append(self, rows: DataFrame) -> None:
        """Append the rows to their pipelines' folders, one job each: jobs that write to one folder
        at a time would share its temporary files."""
        for row in rows.collect():  # one row a pipeline
            own = self.spark.createDataFrame([row], rows.schema).drop("pipeline_name")
            own.coalesce(1).write.mode("append").parquet(f"{self.path}/pipeline_name={row['pipeline_name']}")

    def _states(self) -> DataFrame:
        names = [f.name for f in schemas.WATERMARK.fields if f.name != "pipeline_name"]
        rows = self.spark.read.schema(f"{schemas.ddl(schemas.WATERMARK)}, version bigint").parquet(self.path)
        newest = F.max(F.struct("version", "last_watermark", *[n for n in names if n != "last_watermark"])).alias("s")
        return rows.groupBy("pipeline_name").agg(newest).select("pipeline_name", *[f"s.{n}" for n in names], "s.version")

    def read(self) -> DataFrame:
        return self._states().drop("version")

    def record(self, loads: DataFrame, at=None) -> None:
        """Append the states that :func:`moved` gives the pipelines of ``loads``."""
        states = self._states()
        after = moved(states.drop("version"), loads, at).join(loads.select("pipeline_name"), "pipeline_name", "left_semi")
        self._append(after.join(states.select("pipeline_name", (F.col("version") + 1).alias("version")), "pipeline_name"))

    def move(self, pipeline: str, watermark, status: str, rows: int | None) -> None:
        """Record one load; a ``watermark`` or ``rows`` of None leaves the last one in place."""
        self.record(self.spark.createDataFrame([(pipeline, watermark, status, rows)], LOADS))
