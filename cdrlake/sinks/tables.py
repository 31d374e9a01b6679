"""Parquet writers, layout, catalog registration and copies."""

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import size_in_bytes


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """Observed figures; zeros where no task ran, as over an empty input."""
    try:
        return dict(seen.get)
    except Py4JJavaError as e:
        if "assertion failed" not in str(e.java_exception):
            raise
        return dict.fromkeys(names, 0)


def _beside(spark: SparkSession, path: str, prefix: str):
    """(file system, path, a hidden sibling of it); readers pass over names that begin with an underscore."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, target, spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), prefix + target.getName())


def settle(spark: SparkSession, path: str) -> None:
    """Bring a folder back whose replacement was cut off half way; remove what a complete one left."""
    fs, target, old = _beside(spark, path, "_old-")
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        else:
            _rename(fs, old, target)


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be renamed to {target}")


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A new folder to write to, which takes the place of ``path`` once everything in it is written.

    A write that fails leaves the folder as it was, and the rows written may come from the
    folder itself.  Two renames change the folders; on file systems with directories they
    move no data.  :func:`settle`, also run here first, mends a driver lost between the two.
    """
    settle(spark, path)
    fs, target, new = _beside(spark, path, f"_new-{uuid.uuid4().hex}-")
    try:
        yield str(new)
    except BaseException:
        fs.delete(new, True)
        raise
    old = _beside(spark, path, "_old-")[2]
    if fs.exists(target):
        _rename(fs, target, old)
    _rename(fs, new, target)
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    dynamic: bool = False,
    balanced: bool = True,
) -> int:
    """Overwrite a table and return the number of rows written.

    By default the whole table is replaced, by :func:`replacing`; ``dynamic`` replaces only
    the partitions in ``df``, which Spark swaps when all tasks are done.  Before a partitioned write the rows are rebalanced by the partition
    column: Spark merges small pieces and splits a month that holds most rows, so
    files are few and of even size.  The count is taken in the writing stage itself,
    where a task counts once however often it runs.
    """
    rows = df.hint("rebalance", partition_by) if partition_by and balanced else df
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if partition_by and dynamic:
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        with replacing(df.sparkSession, path) as new:
            writer.parquet(new)
    return observed(seen, "rows")["rows"]


def write_csv(df: DataFrame, path: str, partition_by: str | None = None, compression: str = "none") -> None:
    """CSV with a header, in place of what was there; spaces around values are kept."""
    writer = (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", compression)
    )
    with replacing(df.sparkSession, path) as new:
        (writer.partitionBy(partition_by) if partition_by else writer).csv(new)


def together(jobs: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run independent Spark jobs at the same time, so that the tail of one does not
    leave the cluster idle.  The first failure is raised once all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: done.result() for name, done in running.items()}


def publish_gold(base: str, tables: dict[str, tuple[DataFrame, str | None]], balanced: bool = True) -> dict[str, int]:
    """Write several Gold tables, each with an optional partition column."""
    return together(
        {
            name: lambda name=name, df=df, by=by: write_table(df, f"{base}/gold/{name}", by, balanced=balanced)
            for name, (df, by) in tables.items()
        }
    )


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job wrote for itself, once what is made of it is written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_partitions(spark: SparkSession, path: str, column: str, values: list[str]) -> None:
    """Remove the folders of the given partitions."""
    for value in values:
        remove(spark, f"{path}/{column}={value}")


def _stored_shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def register_catalog(spark: SparkSession, database: str, base: str, names: list[str], location=None) -> list[str]:
    """A database and one external Parquet table per Gold folder; returns the tables whose entry was renewed.

    The entry of a table keeps the columns and partitions it was made with.  Where the
    folder has others now, the entry is dropped and made again; the files stay.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    renewed = []
    for name in names:
        table, path = f"{database}.{name}", f"{base}/gold/{name}"
        if spark.catalog.tableExists(table):
            # the newest columns: files of an appended table may differ
            stored = spark.read.option("mergeSchema", True).parquet(path)
            if sorted(_stored_shape(stored)) != sorted(_stored_shape(spark.table(table))):
                spark.sql(f"DROP TABLE {table}")
                renewed.append(name)
        if not spark.catalog.tableExists(table):
            spark.catalog.createTable(table, path=path, source="parquet", schema=spark.read.option("mergeSchema", True).parquet(path).schema)
        if any(c.isPartition for c in spark.catalog.listColumns(table)):
            spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
    return renewed


def files_for(df: DataFrame, target: int = 128 << 20, least: int = 4 << 20) -> int:
    """Number of files for a stored table: some ``target`` bytes each, smaller ones while cores would be idle."""
    size, cores = size_in_bytes(df), df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // target), min(cores, -(-size // least)))


def cluster_for_read(df: DataFrame, columns: list[str], spread: str, n: int | None = None) -> DataFrame:
    """Range-partition and sort by the columns, so that file statistics skip data.

    ``spread`` is a unique column; its hash is the last range key and lets a single
    hot value of the columns be split over several files.  The ranges come from a sample,
    so ``df`` is read twice and should be a stored table.
    """
    keys = [F.col(c) for c in columns] + [F.xxhash64(spread)]
    ranged = df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*columns)


def compact(spark: SparkSession, path: str, out: str, partition_by: str | None = None) -> int:
    """Rewrite a folder of many small files, as streams leave them, into few."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return write_table(df if partition_by else df.hint("rebalance"), out, partition_by)


def append_merge(df: DataFrame, path: str) -> None:
    """Append rows whose columns may be new; read them with :func:`read_merged`."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def copy_csv_to_parquet(df: DataFrame, columns: list[str], path: str, partition_by: str = "call_date") -> int:
    """Copy the named columns of raw rows to Parquet, one folder per date."""
    return write_table(df.select(*columns), path, partition_by)
