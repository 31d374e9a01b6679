"""Near-duplicates by SimHash: linked where at most ``radius`` of 64 bits differ.

Fingerprints come from 4-word shingles of the whole text (see :func:`fingerprints`).
Equal ones are one node.  Two of at most 4 differing bits agree in 2 of 6 blocks of
bits, so every fingerprint goes to the 15 buckets of its pairs of blocks (21 bits
wide on average) and meets there whatever it may link to: no link is lost.

Within a bucket fingerprints are compared bit-sliced.  Bit planes are stored
vertically, 64 fingerprints to a word; one fingerprint against a word updates 64
distances at once in carry-save counters, and a word is abandoned once all of its
distances are over the radius.  The comparison of many fingerprints is one numpy
operation per plane.  A bucket hands on a star per group, never its pairs.

A bucket of more than ``tile`` fingerprints is dealt out: its fingerprints fall into
tiles, and every two tiles meet in a task of their own.

Defined results: null and empty texts have fingerprint zero and link like any other.
The component is named by its smallest document id; rows of null id take part and
name a component only if it has no other.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import freeing, hot_join, row_of, saved, ship, with_fields
from .components import components

RADIUS = 4
SHINGLE = 4
BLOCKS = (11, 11, 11, 11, 10, 10)
TILE = 4_096
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash over XXH64 (seed 42) of the shingles, repeats included; zero without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    hashed = [xxhash.xxh64_intdigest(joined[a:z], 42) for a, z in zip(starts[:n].tolist(), last.tolist())]
    bits = np.unpackbits(np.array(hashed, dtype="<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > n
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str, keep: list[Column], shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` with ``fp``, the fingerprint as a signed long."""
    ship(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("__text"))
    out = rows.drop("__text")
    names = [*out.columns, "fp"]

    def run(batches):
        for b in freeing(batches):
            own = np.array([fingerprint(t, shingle) for t in b.column(len(names) - 1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(own.view(np.int64))], names=names)

    return rows.mapInArrow(run, with_fields(out.schema, "fp long"))


def close_pairs(values: np.ndarray, ends: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j), i < j < ends[i], of values that differ in ``radius`` bits at most.

    ``ends`` gives, for each place, where the group it stands in ends.
    """
    n = len(values)
    words = -(-n // 64)
    lanes = np.zeros(words * 64, dtype=np.uint64)
    lanes[:n] = values
    raw = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(raw.T, axis=1, bitorder="little")).view("<u8")  # plane, word
    query = raw[:n]  # bit of each value
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    left, right = [], []
    active, ahead = np.flatnonzero(np.arange(1, n + 1) < ends), 0
    while len(active):
        word = active // 64 + ahead
        low = np.maximum(active + 1 - word * 64, 0)
        high = np.minimum(ends[active] - word * 64, 64)
        # lanes of the group behind the value itself; the others count as over the radius
        some = high > low
        wide = np.where(high >= 64, every, (np.uint64(1) << np.minimum(high, 63).astype(np.uint64)) - np.uint64(1))
        over = ~(wide & ~((np.uint64(1) << np.minimum(low, 63).astype(np.uint64)) - np.uint64(1)) & np.where(some, every, np.uint64(0)))
        who, at = active, word
        counters = [np.zeros(len(who), dtype=np.uint64) for _ in range(3)]
        for bit in range(64):
            differ = planes[bit][at] ^ (np.uint64(0) - query[who, bit].astype(np.uint64))
            carry = differ
            for c in counters:  # carry-save: ones, twos, fours
                c ^= carry
                carry = carry & ~c
            over |= carry
            if bit % 4 == 3:
                over |= _above(counters, radius)
                live = over != every
                if not live.all():
                    who, at, over = who[live], at[live], over[live]
                    counters = [c[live] for c in counters]
                    if not len(who):
                        break
        if len(who):
            near = np.unpackbits(np.ascontiguousarray(~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(near)
            left.append(who[row])
            right.append(at[row] * 64 + lane)
        ahead += 1
        active = active[(active // 64 + ahead) * 64 < ends[active]]
    if not left:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count in the three counters is over the radius (below 8)."""
    ones, twos, fours = counters
    bits = [ones, twos, fours]
    over, equal = np.zeros_like(ones), np.full_like(ones, 0xFFFFFFFFFFFFFFFF)
    for k in (2, 1, 0):
        if radius >> k & 1:
            equal = equal & bits[k]
        else:
            over |= equal & bits[k]
            equal = equal & ~bits[k]
    return over


def _stars(values: np.ndarray, ends: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, smallest place's value) of the places that are linked within their groups."""
    i, j = close_pairs(values, ends, radius)
    label = np.arange(len(values))
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect what is linked, of distinct fingerprints ``fp``."""
    ship(prints.sparkSession)
    if radius >= len(BLOCKS) - 1:
        raise ValueError("the blocks guarantee a radius of at most 4")
    keep = len(BLOCKS) - radius
    starts = [sum(BLOCKS[:k]) for k in range(len(BLOCKS))]
    part = [F.shiftrightunsigned("fp", starts[k]).bitwiseAND((1 << BLOCKS[k]) - 1) for k in range(len(BLOCKS))]
    buckets = []
    for number, picked in enumerate(combinations(range(len(BLOCKS)), keep)):
        key = F.lit(number).cast("long")
        for k in picked:
            key = F.shiftleft(key, BLOCKS[k]).bitwiseOR(part[k])
        buckets.append(key)
    rows = prints.select("fp", F.explode(F.array(*buckets)).alias("key"))
    large = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > tile)
    rows = rows.join(large.select("key", F.ceil(F.col("n") / tile).cast("int").alias("c")), "key", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("c") - 1), lambda o: F.least(own, o) * F.col("c") + F.greatest(own, o))
    tiles = F.when(F.col("c").isNull(), F.array(F.lit(0))).otherwise(pairs)
    rows = rows.select("fp", "key", F.explode(tiles).alias("t"))

    def compare(batches):
        """Rows come sorted by group; the open group at the end of a batch waits for the next."""
        rest = None
        for b in _with_end(batches):
            if b is None:
                own, done = rest, True
            else:
                own = [b.column(k).to_numpy() for k in range(3)]
                if rest is not None:
                    own = [np.r_[x, y] for x, y in zip(rest, own)]
                done = False
            if own is None or not len(own[0]):
                continue
            new = np.r_[True, (own[1][1:] != own[1][:-1]) | (own[2][1:] != own[2][:-1])]
            firsts = np.flatnonzero(new)
            if not done:
                rest = [x[firsts[-1] :] for x in own]
                own = [x[: firsts[-1]] for x in own]
                firsts = firsts[:-1]
                if not len(firsts):
                    continue
            sizes = np.diff(np.r_[firsts, len(own[0])])
            ends = np.repeat(np.cumsum(sizes), sizes)
            big = np.repeat(sizes > 1, sizes)
            values = own[0][big].astype(np.int64).view(np.uint64)
            shift = np.cumsum(~big)[big]
            a, z = _stars(values, ends[big] - shift, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(z.view(np.int64))], names=["a", "b"])

    return rows.repartition("key", "t").sortWithinPartitions("key", "t", "fp").mapInArrow(compare, "a long, b long").distinct()


def _with_end(batches):
    yield from batches
    yield None


def near_components(rows: DataFrame, doc_id: str) -> DataFrame:
    """``rows`` (with ``fp``) and ``component_id``, the smallest id of those that are linked, directly or not."""
    least = rows.groupBy("fp").agg(F.min(doc_id).alias("least"))
    groups = components(saved(links(least.select("fp")), "links"))
    named = least.join(groups.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = saved(named, "nodes")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = hot_join(named.select("fp", "root"), names, ["root"], ["fp"]).drop("root")
    # copies of one text share a fingerprint, so their rows are dealt out by all of their columns
    return hot_join(rows, of_print, ["fp"], [c for c in rows.columns if c != "fp"])


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    rows = saved(fingerprints(docs, text, [F.col(doc_id).alias("doc_id")]), "simhash")
    return near_components(rows, "doc_id").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id, with all columns of ``docs``.

    Documents are linked where their SimHashes over five-word shingles differ in ``RADIUS``
    bits at most, or by :mod:`.similar`, which finds texts of a similarity of 0.8.  Of rows
    with the same id the one whose text has the smallest hash stays, and of equal rows one.
    """
    from .similar import SHINGLE as FIVE
    from .similar import similar_links

    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"), F.col("text").alias("t"))
    prints = saved(fingerprints(rows, "t", [F.col("id"), F.col("h")], FIVE), "simhash")
    # a text is a node, named by its hash; those of one fingerprint are linked by the fingerprint's smallest
    nodes = prints.groupBy("h").agg(F.min("fp").alias("fp"))
    least = nodes.groupBy("fp").agg(F.min("h").alias("h"))
    known = saved(nodes, "texts")
    same = hot_join(known, least.withColumnRenamed("h", "b"), ["fp"], ["h"]).select(F.col("h").alias("a"), "b").filter("a <> b")
    close = links(known.select("fp").distinct())
    named = least.select(F.col("fp").alias("a"), F.col("h").alias("x"))
    close = close.join(named, "a").join(named.withColumnsRenamed({"a": "b", "x": "y"}), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    texts = rows.select(F.col("h").alias("node"), F.col("t").alias("text")).dropDuplicates(["node"])
    edges = saved(same.unionByName(close).unionByName(similar_links(texts)), "links")
    groups = components(edges).select(F.col("node").alias("h"), "root")
    grouped = saved(hot_join(prints.select("id", "h"), known.join(groups, "h", "left").select("h", F.coalesce("root", "h").alias("root")), ["h"], ["id"]), "groups")
    # null ids come last
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("best")
    chosen = grouped.groupBy("root").agg(best).select("best.id", "best.h").distinct()
    there = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("i")
    own = docs.select(row_of(docs).alias("row"), there, F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"))
    picked = own.join(chosen.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("i"), "h"), ["i", "h"], "left_semi")
    first = F.row_number().over(Window.partitionBy("i", "h").orderBy(F.lit(0)))
    return picked.withColumn("n", first).filter("n = 1").select("row.*")
