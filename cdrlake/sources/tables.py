"""Readers of lake tables and their registration as views."""

from pyspark.sql import DataFrame, SparkSession

GOLD_VIEWS = ["arpu_monthly", "customer_summary", "regional_kpis", "daily_trend", "churn_scores"]


def read_table(spark: SparkSession, base: str, layer: str, name: str, **options) -> DataFrame:
    """A Parquet table ``<base>/<layer>/<name>``."""
    return spark.read.options(**options).parquet(f"{base}/{layer}/{name}")


def register(**frames: DataFrame) -> None:
    """Temporary views under the given names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def register_gold_views(spark: SparkSession, base: str, names: list[str] = GOLD_VIEWS) -> None:
    """``gold_<name>`` over each Gold folder; filters on a view reach the files."""
    register(**{f"gold_{name}": read_table(spark, base, "gold", name) for name in names})


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Name, time and size of what lies directly in a folder; no file is opened."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return tuple(sorted((f.getPath().getName(), f.getModificationTime(), f.getLen()) for f in found))


def size_in_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of the plan; file sizes for a plain scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Spread an input too small to give every core a file split over the cores.

    A small file in one row group is read by one task, and the work before the
    first shuffle would stay there.  Inputs above one split per core pass through.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores, *keys) if size_in_bytes(df) < cores * split else df
