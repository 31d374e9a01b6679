"""What Python workers still hold when a task has ended."""

import gc

import pyarrow as pa

from cdrlake.llm import decontam, pieces
from cdrlake.llm.queries import PIECES

SF = "/root/testdata/sf0.001"


def test_workers_keep_no_words_of_earlier_tasks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(4).cache()
    assert len(pieces.round_trip(docs, PIECES).collect()) == docs.count()
    assert decontam.leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()

    def held(batches):
        for b in batches:
            found = [o for o in gc.get_objects() if isinstance(o, (pieces.Lattice, decontam.WordHashes))]
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(o.known) for o in found)] * b.num_rows, pa.int64())], names=["n"])

    assert {r["n"] for r in spark.range(0, 64, 1, 16).mapInArrow(held, "n long").collect()} == {0}
