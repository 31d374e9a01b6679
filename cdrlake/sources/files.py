"""Bronze files: typed CSV scans, rejected rows, file listings by date."""

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..functions.casting import as_column, to_d
from ..operators.filters import active, in_window
from ..sinks.tables import observed, write_csv

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """Typed rows; a file whose header names other columns, or in another order, is an error."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def read_cdr(spark: SparkSession, path, window_start: str, window_end: str) -> DataFrame:
    """CDRs whose call date text lies in the window, both ends included."""
    return in_window(read_csv(spark, path, schemas.CDR), "call_date", window_start, window_end)


def read_customers(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMER)


def read_recharges(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, schemas.RECHARGE)


def typed_or_misfit(schema: StructType) -> tuple[list[Column], Column]:
    """Casts to the schema, and the first column whose value does not fit its type, or NULL."""
    casts = [F.col(f.name).try_cast(f.dataType) for f in schema.fields]
    misfits = [F.when(F.col(f.name).isNotNull() & cast.isNull(), f.name) for f, cast in zip(schema.fields, casts)]
    return [cast.alias(f.name) for f, cast in zip(schema.fields, casts)], F.coalesce(*misfits)


#: reason of a line with too few or too many fields
FIELDS = "fields"


def typed_rows(spark: SparkSession, paths, schema: StructType, *more: Column) -> DataFrame:
    """Typed columns of CSV files, columns of ``more``, ``reject_reason`` and ``line``.

    The reason is NULL for rows that fit.  It is the first column whose value does not fit
    its type, or :data:`FIELDS`, and ``line`` is then the text as it came.  The fields are
    read as text and cast here: the CSV reader converts only the selected fields, and would
    miss a bad value in another one.
    """
    text = StructType([StructField(n, StringType()) for n in [*schema.names, CORRUPT]])
    rows = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(text)
        .csv(paths)
    )
    casts, misfit = typed_or_misfit(schema)
    reason = F.when(F.col(CORRUPT).isNotNull(), FIELDS).otherwise(misfit)
    line = F.when(reason.isNotNull(), F.coalesce(CORRUPT, F.to_csv(F.struct(*schema.names))))
    return rows.select(*casts, *more, reason.alias("reject_reason"), line.alias("line"))


def read_with_rejects(spark: SparkSession, path, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines with their reason)."""
    rows = typed_rows(spark, path, schema)
    good = rows.where(F.col("reject_reason").isNull()).select(*schema.names)
    return good, rows.where(F.col("reject_reason").isNotNull()).select("line", "reject_reason")


OUTCOMES = ("written", "rejected")


def extract_active_customers(source: DataFrame, path: str) -> dict[str, int]:
    """Write the active customers of a source table as CSV, and return the rows of each outcome.

    One pass over the source routes every row to a folder: rows that fit the customer
    schema to ``outcome=written``, others as they are to ``outcome=rejected``.  The counts
    are taken in the writing stage itself, where a task counts once however often it runs.
    """
    names = schemas.CUSTOMER.names
    casts, misfit = typed_or_misfit(schemas.CUSTOMER)
    rows = active(source).select(*names, misfit.alias("__misfit"))
    fits = F.col("__misfit").isNull()
    out = rows.select(
        *[F.when(fits, cast.cast("string")).otherwise(F.col(n).cast("string")).alias(n) for n, cast in zip(names, casts)],
        F.when(fits, OUTCOMES[0]).otherwise(OUTCOMES[1]).alias("outcome"),
    )
    seen = Observation()
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
    write_csv(out.observe(seen, *counts), path, "outcome")
    return observed(seen, *OUTCOMES)


def read_extract(spark: SparkSession, path: str, outcome: str = OUTCOMES[0]) -> DataFrame:
    """Rows of one outcome of an extract; rejected ones as text."""
    kinds = schemas.CUSTOMER.fields if outcome == OUTCOMES[0] else [StructField(n, StringType()) for n in schemas.CUSTOMER.names]
    rows = read_csv(spark, path, StructType([*kinds, StructField("outcome", StringType())]))
    return rows.where(F.col("outcome") == outcome).drop("outcome")


def load_customers_staging(spark: SparkSession, path) -> DataFrame:
    """Customer CSV as typed staging rows: fee as decimal, dates and times parsed."""
    raw = read_customers(spark, path)
    casts = {
        "monthly_fee_qar": "decimal(10,2)",
        "activation_date": "date",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    }
    return raw.withColumns({name: F.col(name).try_cast(kind) for name, kind in casts.items()})


def jdbc_read(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """A relational query; give ``partitionColumn`` and bounds to read in parallel."""
    key = "dbtable" if "partitionColumn" in options else "query"
    target = f"({query}) q" if key == "dbtable" else query
    return spark.read.format("jdbc").option("url", url).option(key, target).options(**options).load()


def jdbc_reload(df: DataFrame, url: str, table: str, batch: int = 100, **options) -> None:
    """Empty a relational table, keeping its definition, and load it in batches."""
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .option("truncate", True)
        .option("batchsize", batch)
        .option("url", url)
        .option("dbtable", table)
        .options(**options)
        .save()
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified, bytes) of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def file_date(path, prefix: str) -> Column:
    """Date in a name such as ``cdrs_2024_10_01.csv`` or ``recharges_2024-10``.

    A missing day means the first of the month; a name without a date gives NULL.
    """
    # searched once: a scan does so for each row
    found = F.regexp_extract(as_column(path), rf".*{prefix}[_-](\d{{4}}[_-]\d{{2}}(?:[_-]\d{{2}})?)", 1)
    day = F.when(F.length(found) > 7, F.substring(found, 9, 2)).otherwise("01")
    return to_d(F.concat_ws("-", F.substring(found, 1, 4), F.substring(found, 6, 2), day))


#: columns that tell a version of a file
FILE = ["path", "modified", "bytes"]


def new_files(files: DataFrame, prefix: str, watermark, loaded: DataFrame | None = None) -> DataFrame:
    """The dated files that were not loaded yet, with their ``file_date``.

    ``loaded`` has the loaded files' path, time and size; without it, files dated after the
    watermark are new.
    """
    dated = files.withColumn("file_date", file_date("path", prefix)).where(F.col("file_date").isNotNull())
    if loaded is None:
        return dated.where(F.col("file_date").cast("timestamp") > watermark)
    return dated.join(loaded, FILE, "left_anti")


def literal(path: str) -> str:
    """A path whose characters stand for themselves, also those of patterns."""
    return re.sub(r"([\\\[\]{}*?^,])", r"\\\1", path)


def read_listed(spark: SparkSession, paths: list[str], prefix: str, schema: StructType) -> DataFrame:
    """:func:`typed_rows` of exactly the listed files, with ``file_date`` and ``source_file``."""
    path = F.col("_metadata.file_path")
    name = F.concat(F.col("_metadata.file_name"), F.lit("-"), F.substring(F.md5(path), 1, 16))
    return typed_rows(
        spark, [literal(p) for p in paths], schema, file_date(path, prefix).alias("file_date"), name.alias("source_file")
    )
