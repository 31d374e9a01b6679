"""Packing of token ids into sequences of a fixed number of tokens.

Each document is cut into blocks of ``capacity`` ids, which are sequences of their own, and
a tail.  The tails are dealt into random groups of some ``GROUP`` tails, and each group is
packed by first-fit decreasing: the tails go, longest first, into the first bin with room,
found by walking down a tournament tree of the bins' free places.  Then the emptiest bins
are taken apart, since documents may be cut freely, and their ids fill the gaps of over
``SLACK`` places in the others.  The one bin that may be left partly filled is cut at powers
of two, which need no padding.

Distribution.  Texts are read once and not shuffled; the ids of the tails are shuffled once
by group.  A group's size does not depend on the keys of the documents but on a hash of each
row's place in the written table of tails, so a frequent id or source cannot make one large.

Defined results: a null text counts as empty and has the end id alone; so has an empty
one.  Rows with equal or null ids are documents of their own (rows of one id may then share
``start``).  A very long text becomes many whole blocks and one tail; its ids are in one
task's memory together.  An empty table gives no pieces.  Other columns are not read, and
their names cannot clash.  Which documents share a group depends on how the input is split
into files and tasks; everything else is fixed by the text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, saved, ship
from .encoding import column_encoder, column_slices

CAPACITY = 2_048
END_ID = 1
GROUP = 4_096
SLACK = 8
#: sequence numbers a group, or a task of whole blocks, can give
_NUMBERS = 1 << 33


class Tournament:
    """Free places of bins; the first bin with room for a size is found in logarithmic time."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [capacity] * (2 * self.leaves)

    def take(self, size: int) -> int:
        """Number of the first bin with ``size`` free places, which are taken."""
        best, at = self.best, 1
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        found = at - self.leaves
        best[at] -= size
        at //= 2
        while at:
            left, right = best[2 * at], best[2 * at + 1]
            best[at] = left if left > right else right
            at //= 2
        return found


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Items of each bin; no item is larger than ``capacity``, and equal sizes keep their order."""
    bins: list[list[int]] = [[] for _ in range(len(sizes))]
    tree = Tournament(len(sizes), capacity)
    for item in np.argsort(-sizes, kind="stable").tolist():
        bins[tree.take(int(sizes[item]))].append(item)
    return [b for b in bins if b]


#: (item, first id of the item's, number of ids)
Part = tuple[int, int, int]


def filled(bins: list[list[int]], sizes: np.ndarray, capacity: int, slack: int) -> list[list[Part]]:
    """Sequences of parts of items: gaps of over ``slack`` places are filled with the emptiest bins' ids."""
    parts = [[(i, 0, int(sizes[i])) for i in b] for b in bins]
    free = [capacity - sum(n for _, _, n in own) for own in parts]
    out = [own for own, left in zip(parts, free) if left <= slack]
    gaps = sorted((b for b in range(len(parts)) if free[b] > slack), key=lambda b: (free[b], b))
    low, high, loose = 0, len(gaps), []
    while loose or high - low > 1:
        if not loose:
            high -= 1
            loose = parts[gaps[high]]
        if low == high:
            break
        into, (item, at, n) = gaps[low], loose.pop()
        used = min(n, free[into])
        parts[into].append((item, at, used))
        free[into] -= used
        if used < n:
            loose.append((item, at + used, n - used))
        if free[into] <= slack:
            out.append(parts[into])
            low += 1
    last = loose or [part for b in gaps[low:high] for part in parts[b]]
    return out + at_powers_of_two(last)


def at_powers_of_two(parts: list[Part]) -> list[list[Part]]:
    """One sequence cut into sequences whose lengths are powers of two, longest first."""
    left, out, queue = sum(n for _, _, n in parts), [], list(reversed(parts))
    while left:
        want, own = 1 << (left.bit_length() - 1), []
        left -= want
        while want:
            item, at, n = queue.pop()
            used = min(n, want)
            own.append((item, at, used))
            want -= used
            if used < n:
                queue.append((item, at + used, n - used))
        out.append(own)
    return out


def blocks_and_tails(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, doc_id: str, text: str) -> DataFrame:
    """One row for each block and tail of the documents' ids; blocks have a sequence already."""
    ship(docs.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
         ("row", pa.int64()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, row = TaskContext.get().partitionId() * _NUMBERS, 0
        for b in batches:
            names, column = b.column(0).to_pylist(), b.column(1)
            for start, stop in column_slices(column):
                flat, counts = column_encoder(tokenizer).encode(column.slice(start, stop - start), end_id)
                raw, ends = memoryview(flat.astype("<u4").tobytes()), np.cumsum(counts)
                out = {f.name: [] for f in schema}
                for name, n, end in zip(names[start:stop], counts.tolist(), ends.tolist()):
                    for at in range(0, n, capacity):
                        size, whole = min(capacity, n - at), n - at >= capacity
                        out["doc_id"].append(name)
                        out["start"].append(at)
                        out["doc_tokens"].append(n)
                        out["sequence_id"].append(2 * (first + row) + 1 if whole else None)
                        out["row"].append(first + row)
                        out["ids"].append(bytes(raw[4 * (end - n + at) : 4 * (end - n + at + size)]))
                        row += 1
                yield batch(schema, **out)

    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("d"), F.col(f"`{text}`").alias("t"))
    return own.mapInArrow(run, "doc_id long, start long, doc_tokens long, sequence_id long, row long, ids binary")


PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
)


def packed_tails(tails: DataFrame, capacity: int, group: int, slack: int) -> DataFrame:
    """The pieces of the tails, packed in random groups of about ``group`` of them."""
    n = tails.count()
    groups = max(1, -(-n // group))
    dealt = tails.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        ids = table.column("ids").to_pylist()
        sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        sequences = filled(first_fit_decreasing(sizes, capacity), sizes, capacity, slack)
        names, starts, tokens = (table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        out = {f.name: [] for f in _SCHEMA}
        for number, parts in enumerate(sequences):
            offset = 0
            for item, at, size in parts:
                out["doc_id"].append(names[item])
                out["start"].append(starts[item] + at)
                out["length"].append(size)
                out["doc_tokens"].append(tokens[item])
                out["sequence_id"].append(2 * (key[0].as_py() * _NUMBERS + number))
                out["offset"].append(offset)
                out["ids"].append(ids[item][4 * at : 4 * (at + size)])
                offset += size
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in _SCHEMA})

    # some 20 MB of ids a task, whatever the session's number of partitions
    return dealt.repartition(groups // 4 + 1, "grp").groupBy("grp").applyInArrow(run, PIECE)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP, slack: int = SLACK,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The pieces of all sequences with their ids (little-endian unsigned 32-bit).

    Ordered by ``offset``, the pieces of one ``sequence_id`` are a sequence of at most
    ``capacity`` ids.  ``start`` counts the ids of the piece's document before it.
    """
    cut = saved(blocks_and_tails(docs, tokenizer, capacity, end_id, doc_id, text), "cut")
    blocks = cut.filter("sequence_id IS NOT NULL").select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"), "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"), "ids"
    )
    tails = cut.filter("sequence_id IS NULL").drop("sequence_id")
    return blocks.unionByName(packed_tails(tails, capacity, group, slack))


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
