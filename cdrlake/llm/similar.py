"""Links between texts that share most of their word runs, for the SimHash stage of a pipeline.

Texts of a Jaccard similarity of 0.8 over five-word shingles differ in some ten of the 64
bits of a SimHash, which no affordable number of exact buckets reaches.  So the stage adds
to the links of SimHash those found here: texts whose shingle sets agree in all minima of a
band become candidates, and a candidate is linked if the sets are similar enough.

A band's group is first compared with two of its members, the one that meets most others in
all bands (the original of edited copies, as a rule) and the smallest.  What these links
connect is a class.  Only groups whose other members are of several classes are gone
through again: there, every two members of different classes are compared, so that no two
candidates stay apart that are similar enough.  Such a group is dealt out in tiles, every two
of which meet in a task of their own, and groups of the same members are compared once.
Sets are compared by their ``SKETCH`` smallest hashes: exactly where they have no more
shingles, else with a standard error of at most 0.02.

Texts are counted once however often they occur; a text with fewer words than a shingle is
one shingle, and a text without words has no links.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, freeing, hot_join, saved, ship, text_slices
from .components import components
from .simhash import _LOWER, _with_end

SHINGLE = 5
SIMILAR = 0.8
#: 20 bands of 6 minima: a pair of similarity 0.8 meets with a chance of 0.998
BANDS, MINIMA = 20, 6
SKETCH = 512
#: members of a group that meet in one task, and half of those of two tiles
TILE = 1_024
_KNOWN = 600_000
_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(1, 2**63, BANDS * MINIMA, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 2**63, BANDS * MINIMA, dtype=np.uint64)


class _Words(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingles(texts: list[str | None], known: dict, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of all shingles one text after the other, repeats included, and each text's number."""
    own = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER).split() for t in texts]
    sizes = np.array([len(w) for w in own], dtype=np.int64)
    # a short text's shingle is filled up with zeros
    padded = np.where(sizes > 0, np.maximum(sizes, width), 0)
    words = np.zeros(int(padded.sum()), dtype=np.uint64)
    starts = np.cumsum(padded) - padded
    for at, n, w in zip(starts.tolist(), sizes.tolist(), own):
        words[at : at + n] = np.fromiter(map(known.__getitem__, w), dtype=np.uint64, count=n)
    counts = np.where(padded > 0, padded - width + 1, 0)
    first = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    mixed = np.zeros(len(first), dtype=np.uint64)
    for k in range(width):
        mixed = (mixed ^ words[first + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(32)).astype(np.uint32), counts


def _sketches(rows: DataFrame) -> DataFrame:
    """(node, keys, sketch) of the texts (node, text) that have words."""
    ship(rows.sparkSession)
    schema = pa.schema([("node", pa.int64()), ("keys", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for b in freeing(batches):
            nodes, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for part in text_slices(texts):
                hashed, counts = shingles([texts[i] for i in part], known)
                full = np.flatnonzero(counts)
                if not len(full):
                    continue
                starts = (np.cumsum(counts) - counts)[full]
                wide = hashed.astype(np.uint64)
                keys = np.empty((len(full), BANDS), dtype=np.uint64)
                for band in range(BANDS):
                    key = np.full(len(full), band, dtype=np.uint64)
                    for k in range(band * MINIMA, (band + 1) * MINIMA):
                        least = np.minimum.reduceat((wide * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32), starts)
                        key = (key ^ least) * np.uint64(0xC2B2AE3D27D4EB4F)
                        key ^= key >> np.uint64(31)
                    keys[:, band] = key
                ends = starts + counts[full]
                small = [np.unique(hashed[a:z])[:SKETCH].view(np.int32) for a, z in zip(starts.tolist(), ends.tolist())]
                yield batch(schema, node=[nodes[part[i]] for i in full], keys=list(keys.view(np.int64)), sketch=small)

    return rows.mapInArrow(run, "node long, keys array<long>, sketch array<int>")


def similarity(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Jaccard similarity by the smallest hashes of two sets: exact where both have fewer than ``size``."""
    union = np.union1d(a, b)
    if len(a) >= size or len(b) >= size:
        # beyond the smaller of the two last hashes one of the sketches is blind
        last = min(x[-1] for x in (a, b) if len(x) >= size)
        union = union[union <= last]
    return np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / max(1, len(union))


def similarities(one: np.ndarray, flat: np.ndarray, bounds: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """:func:`similarity` of one set and each of several, which stand one after the other."""
    lengths = np.diff(bounds)
    last = np.where(lengths >= size, flat[bounds[1:] - 1].astype(np.int64), np.int64(1) << 32)
    if len(one) >= size:
        last = np.minimum(last, np.int64(one[-1]))
    seen = flat <= np.repeat(last, lengths)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    both = np.add.reduceat((one[at] == flat) & seen, bounds[:-1], dtype=np.int64)
    union = np.add.reduceat(seen, bounds[:-1], dtype=np.int64) + np.searchsorted(one, last, "right") - both
    return both / np.maximum(1, union)


def unlike_links(nodes: np.ndarray, classes: np.ndarray, flat: np.ndarray, bounds: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links that connect the members of a group that are similar enough and of different classes."""
    # members of a class stand together, so that one of it is compared with a run of the others
    named = np.unique(classes, return_inverse=True)[1]
    order = np.argsort(named, kind="stable")
    lengths = np.diff(bounds)[order]
    starts = bounds[:-1][order]
    flat = np.concatenate([flat[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist())])
    bounds, label, out = np.r_[0, np.cumsum(lengths)], named[order], []
    for i in range(len(order) - 1):
        later = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if not len(later):
            continue
        a = later[0]
        run = slice(bounds[a], bounds[-1])
        found = similarities(flat[bounds[i] : bounds[i + 1]], flat[run], bounds[a:] - bounds[a])
        for j in (np.flatnonzero(found >= least) + a).tolist():
            if label[j] != label[i]:
                out.append((int(nodes[order[i]]), int(nodes[order[j]])))
                label[label == label[j]] = label[i]
    return out


def _rest(met: DataFrame, centre: DataFrame, edges: DataFrame, sketches: DataFrame, least: float, tile: int) -> DataFrame:
    """Links within the bands' groups that the comparison with their centres left out."""
    root = components(edges).select("node", "root")
    known = hot_join(met.select("key", "node"), root, ["node"], ["key"], "left").withColumn("root", F.coalesce("root", "node"))
    known = saved(known, "classes")
    # with a centre every member was compared; others of one class need no comparison
    others = hot_join(known, centre, ["key"], ["node"]).filter("node <> top and node <> low")
    mixed = others.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("key")
    members = hot_join(known, mixed, ["key"], ["node"])
    # of groups with the same members one is enough
    same = members.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("root", "node")).alias("x"))
    picked = saved(same.groupBy("n", "s", "x").agg(F.min("key").alias("key")), "mixed-groups")
    members = hot_join(members, picked.select("key", F.ceil(F.col("n") / tile).cast("int").alias("c")), ["key"], ["node"])
    own = F.pmod(F.xxhash64("node"), F.col("c")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("c") - 1), lambda o: F.least(own, o) * F.col("c") + F.greatest(own, o))
    members = members.select("key", "node", "root", F.explode(tiles).alias("t"))
    rows = hot_join(members, sketches, ["node"], ["key", "t"]).select("key", "t", "node", "root", "sketch")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; the open group at the end of a batch waits for the next."""
        rest = None
        # few rows at a time: a sketch is two kilobytes
        for b in _with_end(b.slice(at, tile) for b in freeing(batches) for at in range(0, b.num_rows, tile)):
            table = pa.Table.from_batches([x for x in (rest, b) if x is not None]) if rest is not None or b is not None else None
            if table is None or not table.num_rows:
                continue
            whole = table.combine_chunks().to_batches()[0]
            key, t = whole.column(0).to_numpy(), whole.column(1).to_numpy()
            firsts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (t[1:] != t[:-1])])
            ends = np.r_[firsts[1:], len(key)]
            if b is not None:
                rest = whole.slice(firsts[-1])
                firsts, ends = firsts[:-1], ends[:-1]
            links: list[tuple[int, int]] = []
            for a, z in zip(firsts.tolist(), ends.tolist()):
                group = whole.slice(a, z - a)
                lists = group.column(4)
                sizes = lists.value_lengths().to_numpy()
                flat = lists.flatten().to_numpy().view(np.uint32)
                links += unlike_links(group.column(2).to_numpy(), group.column(3).to_numpy(), flat, np.r_[0, np.cumsum(sizes)], least)
            if links:
                yield batch(schema, a=[max(x) for x in links], b=[min(x) for x in links])

    return rows.repartition("key", "t").sortWithinPartitions("key", "t", "node").mapInArrow(compare, "a long, b long").distinct()


def similar_links(texts: DataFrame, least: float = SIMILAR, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect the nodes of (node, text) whose texts are at least that similar; nodes are unique.

    Texts that meet in a band are connected if they are similar enough, through others or directly.
    """
    rows = saved(_sketches(texts), "sketches")
    met = rows.select("node", F.explode("keys").alias("key"))
    shared = met.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = saved(hot_join(met, shared, ["key"], ["node"]), "bands")
    # how many others a text meets, in all bands
    degree = met.groupBy("node").agg(F.sum("n").alias("degree"))
    centre = saved(met.join(degree, "node").groupBy("key").agg(F.max_by("node", F.struct("degree", "node")).alias("top"), F.min("node").alias("low")), "centres")
    pairs = hot_join(met.select("key", "node"), centre, ["key"], ["node"]).select("node", F.explode(F.array("top", "low")).alias("centre"))
    pairs = pairs.filter("node <> centre").select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct()
    own = rows.select("node", "sketch")
    left = hot_join(saved(pairs, "candidates").withColumnRenamed("a", "node"), own, ["node"], ["b"])
    left = left.select(F.col("node").alias("a"), F.col("b").alias("node"), F.col("sketch").alias("one"))
    both = hot_join(left, own, ["node"], ["a"]).select("a", F.col("node").alias("b"), "one", F.col("sketch").alias("two"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in freeing(batches):
            one, two = ([x.values.to_numpy().view(np.uint32) for x in b.column(k)] for k in (2, 3))
            near = np.array([similarity(x, y) >= least for x, y in zip(one, two)], dtype=bool)
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(near)) for k in (0, 1)], schema=schema)

    edges = saved(both.mapInArrow(confirm, "a long, b long"), "centre-links")
    return edges.unionByName(_rest(met, centre, edges, own, least, tile))
