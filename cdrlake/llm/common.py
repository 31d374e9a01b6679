"""Helpers shared by the operators: shared scratch tables, row keys, text batches."""

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where that is unset and the master is local, as in tests, a temporary
    folder is made and set as the checkpoint folder.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = os.path.join(tempfile.gettempdir(), "llm-" + spark.sparkContext.applicationId)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_SHIPPED: set[str] = set()
#: Bytes of an Arrow batch; whole texts make batches counted in rows very large.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Give this package to the Python workers, wherever the driver imported it from, and bound their batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="llm-")) / "cdrlake_workers.zip"
        with zipfile.ZipFile(target, "w") as z:
            z.write(package / "__init__.py", "cdrlake/__init__.py")
            for path in sorted(package.glob("llm/*.py")):
                z.write(path, f"cdrlake/llm/{path.name}")
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)
    return spark


def scratch(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/llm/{purpose}-{uuid.uuid4().hex}"


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there."""
    path = scratch(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id gives null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def text_key(text: str) -> Column:
    """128 bits of a text, for equality of long texts; null texts have a key of their own."""
    return F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("null"))


SALTS = 256


def hot_join(rows: DataFrame, unique: DataFrame, keys: list[str], spread: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``unique``, which has one row per key, however many rows share a key.

    Rows of a key are dealt out by a hash of ``spread``; the key's row of ``unique`` is
    repeated once for each of the ``SALTS`` parts at most that its rows really fall into.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("short"))
    # a set of at most SALTS numbers a key, combined before the shuffle
    parts = salted.groupBy(*keys).agg(F.collect_set("__salt").alias("__salt"))
    dealt = unique.join(parts, keys).withColumn("__salt", F.explode("__salt"))
    return salted.join(dealt, [*keys, "__salt"], how).drop("__salt")


def row_of(docs: DataFrame) -> Column:
    """All columns of a row in one struct, so that no name of theirs can clash with a helper's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def freeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``, and then Arrow gives back what it keeps for later: a worker without a task would hold it beside others' tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()


def text_slices(texts: list, limit: int = 200_000) -> Iterator[list[int]]:
    """Indices of ``texts`` in runs of at most ``limit`` characters, or one text where that is longer."""
    run, size = [], 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if run and size + n > limit:
            yield run
            run, size = [], 0
        run.append(i)
        size += n
    if run:
        yield run


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lengths[i] - 1 of all i in one array."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def with_fields(schema: StructType, ddl: str) -> StructType:
    return StructType(schema.fields + StructType.fromDDL(ddl).fields)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
