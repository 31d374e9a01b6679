"""Incremental and full loads driven by the watermark table."""

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import RunResult
from ..operators import control
from ..sinks.tables import observed
from ..sources import files
from ..sources.tables import path_exists
from .runs import audited, now

#: files of a wave; a load goes on until none is left
WAVE = 10_000


def incremental_load(
    spark: SparkSession,
    folder: str,
    prefix: str,
    schema: StructType,
    out: str,
    watermarks: control.ControlTable,
    pipeline: str,
    columns: list[str] | None = None,
    audit_path: str | None = None,
    wave: int = WAVE,
) -> RunResult:
    """Copy the rows of files that were not loaded yet to Parquet, and move the watermark
    to the newest file date copied.

    The manifest ``<out>_manifest`` names every loaded file with its time and size, so a
    late file, a second file of a day and a file that has grown are each loaded once.  Only
    the new files are read.  Each has a folder of its own below its date
    (``file_date=.../source_file=...``), which is overwritten, so a load that failed before
    the manifest was written can run again, and other files of the date stay untouched.
    Rows are copied without a shuffle, in waves of ``wave`` files, oldest first.  Lines that
    do not fit the schema go to ``<out>_rejects`` with their reason.

    Daily and monthly files work alike; a month counts as its first day.  Where there is no
    manifest yet, files dated up to the watermark count as loaded; after that the watermark
    is a figure for reports.
    """
    with audited(spark, audit_path, pipeline, watermarks) as run:
        row = control.get_watermark(watermarks.read(), pipeline).first()
        if row is None:
            raise ValueError(f"unknown pipeline {pipeline}")
        run.detail |= {"watermark": row[0], "files": 0}
        run.rows_read[pipeline] = run.rows_written[pipeline] = 0
        manifest = f"{out}_manifest/loaded"
        while True:
            # names of a wave's files, as the scan of any table holds them
            new = _new_files(spark, folder, prefix, manifest, row[0]).orderBy("file_date", "path").limit(wave).collect()
            if new:
                _copy(spark, new, prefix, schema, out, columns or schema.names, run, pipeline)
                # the manifest first: a load that dies before the watermark moves has loaded its files all the same
                listed = spark.createDataFrame([tuple(f[c] for c in files.FILE) for f in new], "path string, modified timestamp, bytes bigint")
                listed.coalesce(1).write.mode("append").parquet(manifest)
                run.detail["files"] += len(new)
            if len(new) < wave:
                break
        if run.rows_written[pipeline]:
            watermarks.move(pipeline, run.detail["watermark"], "SUCCESS", run.rows_written[pipeline])
    return run


def _new_files(spark: SparkSession, folder: str, prefix: str, manifest: str, since: datetime) -> DataFrame:
    """(path, modified, bytes, file_date) of the dated files that the manifest lacks."""
    listed = files.list_files(spark, folder)
    if not path_exists(spark, manifest):
        # what the watermark of a pipeline without manifest covers was loaded before
        new = files.new_files(listed, prefix, F.lit(since)).select("path")
        dated = listed.where(files.file_date("path", prefix).isNotNull())
        dated.join(new, "path", "left_anti").select(files.FILE).write.parquet(manifest)
    known = spark.read.schema(listed.select(files.FILE).schema).parquet(manifest)
    return files.new_files(listed, prefix, F.lit(since), known)


def _copy(spark, new: list, prefix: str, schema: StructType, out: str, columns: list[str], run: RunResult, pipeline: str) -> None:
    """Copy one wave of files, counting the rows read, rejected by reason, and written."""
    rows = files.read_listed(spark, [f["path"] for f in new], prefix, schema)
    reason, reasons = F.col("reject_reason"), [files.FIELDS, *schema.names]
    seen = Observation()
    counted = rows.observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(reason.isNull()).alias("written"),
        F.max(F.when(reason.isNull(), F.col("file_date"))).cast("timestamp").alias("newest"),
        *[F.count_if(reason == r).alias(f"rejected_{r}") for r in reasons],
    )

    def write(df: DataFrame, path: str) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        writer.partitionBy("file_date", "source_file").parquet(path)

    write(counted.where(reason.isNull()).select(*columns, "file_date", "source_file"), out)
    found = observed(seen, "read", "written", *(f"rejected_{r}" for r in reasons))
    run.rows_read[pipeline] += found["read"]
    run.rows_written[pipeline] += found["written"]
    if found["written"]:
        run.detail["watermark"] = max(run.detail["watermark"], found["newest"])
    rejected = {r: found[f"rejected_{r}"] for r in reasons if found[f"rejected_{r}"]}
    for name, n in rejected.items():
        run.quality[f"rejected_{name}"] = run.quality.get(f"rejected_{name}", 0) + n
    if rejected:  # the listed files do not change, and few loads have any
        write(rows.where(reason.isNotNull()).select("reject_reason", "line", "file_date", "source_file"), f"{out}_rejects")


def full_reload_customers(
    source: DataFrame, out: str, watermarks: control.ControlTable, audit_path: str | None = None
) -> RunResult:
    """Extract all active customers to CSV and record the run."""
    pipeline = "customers_full_load"
    with audited(source.sparkSession, audit_path, pipeline, watermarks) as run:
        found = files.extract_active_customers(source, out)
        run.rows_read[pipeline] = sum(found.values())
        run.rows_written[pipeline] = found["written"]
        run.quality["rejected"] = found["rejected"]
        watermarks.move(pipeline, now(), "SUCCESS", found["written"])
    return run
