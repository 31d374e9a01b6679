"""Token ids of a corpus in a bit-plane shuffled, zstandard-compressed format.

A data set is a Parquet table of chunks; each chunk holds whole documents:

    part, chunk    place of the chunk in the order of the corpus
    first          ids of the same part before this chunk
    doc_ids        ids of its documents
    lengths        token counts of its documents, end ids included
    payload        the ids

A payload is a header ``magic(4) n_ids(u4) block(u4) width(u1) kind(u1)``, an index of
one u4 (compressed bytes) per block and plane, and the planes.  A block has ``block``
ids (the last one fewer); plane p has byte p, or bit p, of all of its ids, so
neighbouring bytes are alike.  All numbers are little-endian.

Parquet is the container because its commit protocol survives lost executors.  The
corpus is ranged by document id; Spark sorts the ranges in parallel.

Defined results: a null text counts as empty and has the end id alone.  Rows with a
null id come first; rows of equal id are in the order of their texts.  An empty table
gives an empty data set.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batch, scratch, ship
from .encoding import column_encoder, column_slices

MAGIC = b"BPS1"
BLOCK = 16_384
CHUNK = 262_144
END_ID = 2
_HEADER = struct.Struct("<4sIIBB")


def pack(ids: np.ndarray, block: int = BLOCK, bits: bool = False, level: int = 3) -> bytes:
    ids = np.ascontiguousarray(ids, dtype="<u4")
    top = int(ids.max()) if len(ids) else 0
    width = max(1, top.bit_length()) if bits else max(1, -(-top.bit_length() // 8))
    squeeze = zstandard.ZstdCompressor(level=level).compress
    index, planes = [], []
    for at in range(0, len(ids), block):
        table = ids[at : at + block].view(np.uint8).reshape(-1, 4)
        if bits:
            flat = np.unpackbits(table, axis=1, bitorder="little")[:, :width].T
            own = [np.packbits(p, bitorder="little").tobytes() for p in flat]
        else:
            own = [table[:, p].tobytes() for p in range(width)]
        for plane in map(squeeze, own):
            index.append(len(plane))
            planes.append(plane)
    head = _HEADER.pack(MAGIC, len(ids), block, width, int(bits))
    return b"".join([head, np.array(index, dtype="<u4").tobytes(), *planes])


def unpack(payload: bytes) -> np.ndarray:
    magic, n, block, width, bits = _HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a bit-plane chunk")
    blocks = -(-n // block)
    index = np.frombuffer(payload, dtype="<u4", count=blocks * width, offset=_HEADER.size)
    at = _HEADER.size + 4 * len(index)
    expand = zstandard.ZstdDecompressor().decompress
    out = np.empty(n, dtype="<u4")
    for b in range(blocks):
        size = min(block, n - b * block)
        own = np.zeros((size, 32 if bits else 4), dtype=np.uint8)
        for p in range(width):
            length = int(index[b * width + p])
            plane = np.frombuffer(expand(payload[at : at + length]), dtype=np.uint8)
            own[:, p] = np.unpackbits(plane, count=size, bitorder="little") if bits else plane
            at += length
        out[b * block : b * block + size] = (np.packbits(own, axis=1, bitorder="little") if bits else own).view("<u4").ravel()
    return out


def write(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", bits: bool = False) -> None:
    """The data set of ``docs`` at ``path``."""
    ship(docs.sparkSession)
    schema = pa.schema(
        [("part", pa.int32()), ("chunk", pa.int64()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
         ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]
    )

    def run(batches):
        part = TaskContext.get().partitionId()
        ids, sizes, docs_, held, first, chunk = [], [], [], 0, 0, 0

        def flush():
            flat = np.concatenate(ids) if ids else np.empty(0, dtype=np.uint32)
            row = batch(schema, part=[part], chunk=[chunk], first=[first], doc_ids=[docs_], lengths=[sizes], payload=[pack(flat, bits=bits)])
            return row, len(flat)

        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1)
            for start, stop in column_slices(texts):
                flat, counts = column_encoder(tokenizer).encode(texts.slice(start, stop - start), END_ID)
                cuts, i = np.r_[0, np.cumsum(counts)], 0
                while i < len(counts):
                    # documents up to the one that fills the chunk
                    j = min(len(counts), max(i + 1, int(np.searchsorted(cuts, cuts[i] + CHUNK - held))))
                    ids.append(flat[cuts[i] : cuts[j]])
                    sizes += counts[i:j].tolist()
                    docs_ += names[start + i : start + j]
                    held += len(ids[-1])
                    i = j
                    if held >= CHUNK:
                        row, n = flush()
                        yield row
                        ids, sizes, docs_, held, first, chunk = [], [], [], 0, first + n, chunk + 1
        if docs_:
            yield flush()[0]

    ranged = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")).repartitionByRange("d").sortWithinPartitions("d", "t")
    chunks = ranged.mapInArrow(run, "part int, chunk long, first long, doc_ids array<long>, lengths array<long>, payload binary")
    chunks.write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the data set at ``path``."""
    ship(spark)
    chunks = spark.read.schema(
        "part int, chunk long, first long, doc_ids array<long>, lengths array<long>, payload binary"
    ).parquet(path)
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    # one row per partition of the writing job
    parts = chunks.groupBy("part").agg(F.sum(size).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                raw = unpack(row["payload"]).tobytes()
                cuts = np.r_[0, np.cumsum(row["lengths"])].astype(np.int64)
                crcs = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(cuts[:-1], cuts[1:])]
                yield batch(
                    schema, part=[row["part"]] * len(crcs), doc_id=row["doc_ids"], at=cuts[:-1] + row["first"],
                    n_tokens=row["lengths"], ids_crc32=crcs,
                )

    rows = chunks.select("part", "first", "doc_ids", "lengths", "payload").mapInArrow(run, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(parts, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_bin(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the data set of ``docs`` to the shared folder and digest what is read back."""
    path = scratch(docs.sparkSession, "tokens")
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path)
