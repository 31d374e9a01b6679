"""Removal of repeated byte strings by suffix sorting with difference covers.

A byte goes if a string of ``length`` bytes that covers it also starts earlier in the
corpus (smaller document, or earlier in the same one).

Distribution.  The name of a string (window) is the smallest hash of its 16-byte grams,
so equal windows have equal names; neighbouring windows of one name form a run.
1. Names that occur once in the corpus cannot repeat.  Those that do set bits in a
   bitmap of fixed size, which is broadcast to thin out the runs; it only saves work.
2. Runs of equal name and bytes: the first in the corpus stays (map-side minima), the
   others are repeats as a whole.
3. Where a name has several different runs, or one that may repeat itself, their bytes meet in one task, in portions of
   bounded size.  The difference-cover algorithm sorts the suffixes of a portion: it sorts
   the triples at two of every three places, recurses on their names, sorts the rest by
   first byte and rank, and merges.  Windows next to each other in suffix order are
   compared over ``length`` bytes, and of equal ones the first in the corpus stays.
4. The windows of a name of more than ``most`` different runs are not sorted: equal ones, by
   128 bits of hash, are joined with their first place (map-side minima), so that those of a
   passage in very many documents never meet in one task.

Defined results: null texts count as empty.  Rows equal in id and text count as one
document; of different texts of one id the order is that of a hash.  Null ids come first.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_join, ragged, saved, ship

LENGTH = 100
#: bytes of the grams that name windows, a multiple of 8 below ``LENGTH``: short ones meet by chance in texts
#: that share nothing else, long ones make more runs
GRAM = 32
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
MOST = 2_048
PORTION = 400_000
SLOTS = 1 << 24


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``s`` (numbers from 1 and below 2^21) in order; more than the packed keys hold is an error."""
    n = len(s)
    if n and (s.max() >= 1 << 21 or 2 * n // 3 + 2 >= 1 << 22):
        raise ValueError(f"{n} numbers up to {s.max()} do not fit the packed keys")
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), dtype=np.int64)
    t = np.r_[s, 0, 0, 0].astype(np.uint64)
    # a sample place one behind the end keeps the two halves of the recursion apart
    first = np.arange(1, n + (n % 3 == 1), 3)
    second = np.arange(2, n, 3)
    sample = np.r_[first, second]
    width = np.uint64(21)
    key = (t[sample] << (width * np.uint64(2))) | (t[sample + 1] << width) | t[sample + 2]
    order = np.argsort(key)
    names = np.empty(len(sample), dtype=np.int64)
    names[order] = 1 + np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
    if names.max() < len(sample):
        order = suffix_array(names)
    rank = np.zeros(n + 3, dtype=np.uint64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sample = sample[order]
    sample = sample[sample < n]
    zero = np.arange(0, n, 3)
    zero = zero[np.argsort((t[zero] << np.uint64(22)) | rank[zero + 1])]
    # where each other suffix stands among the sampled ones of either kind
    ones, twos = sample[sample % 3 == 1], sample[sample % 3 == 2]
    by_one = lambda i: (t[i] << np.uint64(22)) | rank[i + 1]
    by_two = lambda i: (t[i] << np.uint64(43)) | (t[i + 1] << np.uint64(22)) | rank[i + 2]
    at = np.arange(len(zero)) + np.searchsorted(by_one(ones), by_one(zero)) + np.searchsorted(by_two(twos), by_two(zero))
    out = np.empty(n, dtype=np.int64)
    taken = np.zeros(n, dtype=bool)
    taken[at] = True
    out[at], out[~taken] = zero, sample
    return out


def window_names(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The name of the window, and the hash of the gram, at each place of ``raw``."""
    n = len(raw) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
    data = np.frombuffer(raw, dtype=np.uint8)
    eights = np.lib.stride_tricks.as_strided(data, (len(raw) - 7, 8), (1, 1))
    eight = np.ascontiguousarray(eights).view("<u8").ravel()
    m = len(raw) - GRAM + 1
    value = eight[:m] * _FACTORS[0]
    for j in range(1, GRAM // 8):
        value += eight[8 * j : 8 * j + m] * _FACTORS[j]
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    hashed, span, done = value, length - GRAM + 1, 1
    while done < span:  # smallest of ever wider stretches of grams
        step = min(done, span - done)
        value = np.minimum(value[:-step], value[step:])
        done += step
    return value[:n], hashed


def _runs(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, first window, number of windows, may repeat itself) of the runs of a text.

    Two windows of one run can be equal only if the gram that names it is there twice.
    """
    names, hashed = window_names(raw, length)
    if not len(names):
        return names, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
    number = np.diff(np.r_[first, len(names)])
    # periodic text has long runs of one name; they are cut so that a run's bytes stay few
    pieces = -(-number // length)
    if pieces.max() > 1:
        first = np.repeat(first, pieces) + length * (np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        end = np.repeat(np.flatnonzero(np.r_[names[1:] != names[:-1], True]) + 1, pieces)
        number = np.minimum(length, end - first)
    names, twice = names[first], np.zeros(len(first), dtype=bool)
    ordered = np.sort(hashed)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(again):  # grams that stand in the text more than once
        at = np.searchsorted(again, names)
        some = np.flatnonzero((at < len(again)) & (again[np.minimum(at, len(again) - 1)] == names))
        if len(some):
            spans = number[some] + length - GRAM
            there = hashed[ragged(first[some], spans)] == np.repeat(names[some], spans)
            twice[some] = np.add.reduceat(there.astype(np.int32), np.cumsum(spans) - spans) > 1
    return names, first, number, twice


def equal_windows(pieces: list[bytes], numbers: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, place, class) of the first ``numbers[i]`` windows of each piece; equal windows share a class."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    joined = b"".join(pieces)
    data = np.frombuffer(joined, dtype=np.uint8)
    wanted = np.zeros(len(data), dtype=bool)
    places = ragged(starts, numbers)
    wanted[places] = True
    order = suffix_array(data.astype(np.int64) + 1)
    order = order[wanted[order]]
    differ = np.zeros(len(order), dtype=bool)
    differ[:1] = True
    # neighbours are compared eight bytes at a time, the last eight as they overlap
    eight = np.ascontiguousarray(np.lib.stride_tricks.as_strided(data, (max(0, len(data) - 7), 8), (1, 1))).view("<u8").ravel()
    for at in [*range(0, length - 8, 8), length - 8] if len(order) > 1 else []:
        words = eight[order + at]
        differ[1:] |= words[1:] != words[:-1]
    piece = np.searchsorted(starts, order, "right") - 1
    return piece, order - starts[piece], np.cumsum(differ)


def repeats(docs: DataFrame, doc_id: str, text: str, length: int = LENGTH, most: int = MOST) -> DataFrame:
    """(d, t, a, z): stretches [a, z) of the documents (id d, text hash t) that are repeats."""
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.xxhash64(text).alias("t"), F.col(text).cast("binary").alias("raw")).filter(F.length("raw") >= length)

    def all_names(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                found = []
                for raw in b.column(0).slice(at, 200):
                    name, _, _, twice = _runs(raw.as_py(), length)
                    found += [name, name[twice]]  # two of those that may repeat themselves
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["h"])

    names = rows.select("raw").mapInArrow(all_names, "h long")
    shared = names.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select(F.pmod("h", F.lit(SLOTS)).cast("int").alias("s")).distinct()
    bits = np.zeros(SLOTS, dtype=bool)
    bits[shared.toArrow()["s"].to_numpy()] = True  # SLOTS numbers at most
    table = spark.sparkContext.broadcast(np.packbits(bits, bitorder="little"))

    def repeated_runs(batches):
        known = np.unpackbits(table.value, bitorder="little").astype(bool)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                where, out = [], [[] for _ in range(5)]
                for i, raw in enumerate(b.column(2).slice(at, 200)):
                    raw = raw.as_py()
                    name, first, number, twice = _runs(raw, length)
                    hit = np.flatnonzero(known[(name.view(np.int64) % SLOTS)])
                    for x, y in zip(out, (name[hit].view(np.int64), first[hit], number[hit], twice[hit])):
                        x.append(y)
                    out[4].append(np.array([xxhash.xxh3_64_intdigest(raw[f : f + k + length - 1]) for f, k in zip(first[hit].tolist(), number[hit].tolist())], np.uint64).view(np.int64))
                    where.append(np.full(len(hit), at + i))
                place = pa.array(np.concatenate(where))
                columns = [pa.array(np.concatenate(x)) for x in out]
                yield pa.RecordBatch.from_arrays([b.column(0).take(place), b.column(1).take(place), *columns], names=["d", "t", "h", "first", "n", "twice", "c"])

    runs = saved(rows.mapInArrow(repeated_runs, "d long, t long, h long, first long, n long, twice boolean, c long"), "runs")
    place = F.struct("d", "t", "first")
    # runs of one name are equal if 64 bits more, of all their bytes, are
    origin = runs.groupBy("h", "c").agg(F.min(place).alias("o"), F.min("n").alias("n"), F.max("twice").alias("twice"), F.count("*").alias("times"))
    origin = saved(origin.select("h", "c", "o.d", "o.t", "o.first", "n", "twice", "times"), "origins")
    whole = runs.join(origin.filter("times > 1").select("h", "c", place.alias("o")), ["h", "c"]).filter(~place.eqNullSafe(F.col("o")))
    whole = whole.select("d", "t", F.col("first").alias("a"), (F.col("first") + F.col("n") + length - 1).alias("z"))

    # names of several different runs: the bytes of each run's first place
    origin = origin.drop("c", "times")
    several = origin.groupBy("h").agg(F.count("*").alias("k"), F.max("twice").alias("twice")).filter("k > 1 OR twice").select("h", "k")

    # whole texts move once, and only those of documents that have such a first place
    need = origin.join(several.select("h", (F.col("k") > most).alias("hot")), "h")
    need = saved(need.groupBy("d", "t").agg(F.collect_list(F.struct("h", "first", "n", "hot")).alias("need")), "needed")
    same = F.col("d").eqNullSafe(F.col("nd")) & (F.col("t") == F.col("nt"))
    sought = marked(rows, marks(need)).join(need.withColumnsRenamed({"d": "nd", "t": "nt"}), same).select("d", "t", "raw", "need")

    def fetch(batches):
        """The bytes of runs, and of hot names each window's hash."""
        names = ["d", "t", "h", "first", "n", "bytes", "w"]
        for b in batches:
            need = b.column(3)
            of = need.value_parent_indices().to_numpy()
            h, first, n, hot = (need.flatten().field(x).to_numpy(zero_copy_only=False) for x in ("h", "first", "n", "hot"))
            raws = b.column(2).to_pylist()
            own = [None if x else raws[i][f : f + k + length - 1] for i, f, k, x in zip(of.tolist(), first.tolist(), n.tolist(), hot)]
            # a run of a hot name gives a row per window
            row = np.repeat(np.arange(len(of)), np.where(hot, n, 1))
            place = first[row] + np.where(hot[row], np.arange(len(row)) - np.searchsorted(row, row), 0)
            w = [xxhash.xxh3_128_digest(raws[i][f : f + length]) if x else None for i, f, x in zip(of[row].tolist(), place.tolist(), hot[row])]
            take = pa.array(of[row])
            columns = [pa.array(h[row]), pa.array(place), pa.array(n[row]), pa.array(own, pa.binary()).take(pa.array(row)), pa.array(w, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *columns], names=names)

    fetched = saved(sought.mapInArrow(fetch, "d long, t long, h long, first long, n long, bytes binary, w binary"), "fetched")
    pieces = fetched.filter("bytes IS NOT NULL").drop("w")
    windows = fetched.filter("w IS NOT NULL").drop("n", "bytes")

    def sort_portions(batches):
        """Whole groups, in portions; a group's rows stand together, those of a repeated document next to each other."""
        waiting, size, last = [], 0, None

        def portion(own):
            number = np.array([x[4] for x in own])
            piece, at, kind = equal_windows([x[5] for x in own], number, length)
            first = np.array([x[3] for x in own])[piece] + at
            # rank of the pieces' documents; ties are the same document
            docs_ = sorted({(x[0] is not None, x[0] or 0, x[1]) for x in own})
            index = {x: i for i, x in enumerate(docs_)}
            doc = np.array([index[(x[0] is not None, x[0] or 0, x[1])] for x in own])[piece]
            order = np.lexsort((first, doc, kind))
            # a window found twice at one place (a repeated row) is one window
            kind, doc, first = kind[order], doc[order], first[order]
            head = np.maximum.accumulate(np.where(np.r_[True, kind[1:] != kind[:-1]], np.arange(len(kind)), 0))
            later = np.flatnonzero((doc != doc[head]) | (first != first[head]))
            doc, first = doc[later], first[later]
            order = np.lexsort((first, doc))
            doc, first = doc[order], first[order]
            cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (first[1:] > first[:-1] + length)]) if len(doc) else np.empty(0, np.int64)
            end = np.r_[cut[1:], len(doc)][: len(cut)] - 1
            picked = [docs_[k] for k in doc[cut]]
            return pa.RecordBatch.from_arrays(
                [pa.array([x[1] if x[0] else None for x in picked], pa.int64()), pa.array([x[2] for x in picked], pa.int64()), pa.array(first[cut]), pa.array(first[end] + length)],
                names=["d", "t", "a", "z"],
            )

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[:4] == last:
                    continue
                if size >= PORTION and row[2] != last[2]:
                    yield portion(waiting)
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row[5])
                last = row[:4]
        if waiting:
            yield portion(waiting)

    parts = pieces.repartition("h").sortWithinPartitions("h", "d", "t", "first").mapInArrow(sort_portions, "d long, t long, a long, z long")
    return whole.unionByName(parts).unionByName(later_windows(windows, length))


def _slot() -> Column:
    return F.pmod(F.xxhash64("d", "t"), F.lit(SLOTS)).cast("int")


def marks(keys: DataFrame):
    """A broadcast bitmap of the documents (d, t): it has bits of others too, and only saves work."""
    bits = np.zeros(SLOTS, dtype=bool)
    bits[keys.select(_slot().alias("s")).distinct().toArrow()["s"].to_numpy()] = True  # SLOTS numbers at most
    return keys.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little"))


def marked(rows: DataFrame, table, wanted: bool = True) -> DataFrame:
    """The rows whose document (d, t) has its bit in the bitmap, or those that have not."""

    def run(batches):
        packed = table.value
        for b in batches:
            slot = b.column(b.num_columns - 1).to_numpy()
            hit = (packed[slot >> 3] >> (slot & 7) & 1).astype(bool) == wanted
            if hit.any():
                yield b.select(list(range(b.num_columns - 1))).filter(pa.array(hit))

    return rows.withColumn("__slot", _slot()).mapInArrow(run, rows.schema)


def later_windows(windows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(d, t, a, z) of the windows (d, t, h, first, w) that stand at an earlier place too; no task holds all places of one."""
    place = F.struct("d", "t", "first")
    earliest = windows.groupBy("h", "w").agg(F.min(place).alias("o"), F.count("*").alias("k")).filter("k > 1").drop("k")
    later = hot_join(windows, earliest, ["h", "w"], ["d", "t", "first"]).filter(~place.eqNullSafe(F.col("o")))
    return later.select("d", "t", F.col("first").alias("a"), (F.col("first") + length).alias("z"))


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row."""
    found = saved(repeats(docs, doc_id, text, length), "repeats")
    spans = found.groupBy("d", "t").agg(F.sort_array(F.collect_set(F.struct("a", "z"))).alias("spans"))
    spans = spans.select(F.coalesce(F.col("d").cast("string"), F.lit("")).alias("i"), "t", "spans")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("d"), F.xxhash64(text).alias("t"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw")
    )
    # texts that lose nothing need not move
    table = marks(found.select("d", "t"))
    some = marked(rows, table).withColumn("i", F.coalesce(F.col("d").cast("string"), F.lit("")))
    joined = some.join(spans, ["i", "t"], "left").select("d", "raw", "spans")
    whole = marked(rows, table, False).select("d", "raw", F.lit(None).cast("array<struct<a:long,z:long>>").alias("spans"))

    def cut(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                out = [[] for _ in range(5)]
                for raw, own in zip(b.column(1).slice(at, 500), b.column(2).slice(at, 500)):
                    raw, merged = raw.as_py(), []
                    for x in own.as_py() or []:
                        if merged and x["a"] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], x["z"])
                        else:
                            merged.append([x["a"], x["z"]])
                    kept, last = hashlib.sha256(), 0
                    for a, z in merged:
                        kept.update(raw[last:a])
                        last = z
                    kept.update(raw[last:])
                    for x, y in zip(out, (len(raw), sum(z - a for a, z in merged), len(merged), kept.hexdigest(), merged)):
                        x.append(y)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 500), *(pa.array(x, k) for x, k in zip(out, kinds))],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
                )

    return joined.unionByName(whole).mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
