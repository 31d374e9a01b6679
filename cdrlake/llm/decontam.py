"""Benchmark decontamination by greedy string tiling.

Texts are sequences of lower-cased words.  Seeds are runs of ``min_match`` words.
1. The seeds of all benchmark items set bits in a bitmap of fixed size, which is
   broadcast; a document keeps the words that lie in a run whose seed hits it.
2. Seeds of documents and items are joined; a pair stays if its seeds could cover
   ``min_coverage`` of the item.
3. Greedy string tiling of the pair: the longest matches of unmarked words are found by
   running Karp-Rabin hashes, marked, and so on down to ``min_match`` words.  Matches
   may stand in any order, so reordered passages count in full.
4. An item leaks into a document if its tiles cover ``min_coverage`` of its words.

Defined results: null and empty texts, and items of fewer than ``min_match`` words,
match nothing.  Rows equal in id and text count once, as do repeated items; each text of
an item id, also of a null one, is an item of its own.  Among equally long matches the first in the item, then in the
document, is marked first.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, freeing, ragged, row_of, saved, ship, text_key

MIN_MATCH = 5
MIN_COVERAGE = 0.5
SLOTS = 1 << 22
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class WordHashes:
    """64-bit hashes of the words of texts; stretches without white space met before are remembered up to a bound."""

    def __init__(self, bound: int = 600_000):
        self.bound = bound
        self.known: dict[str, int] = {}
        self.starts = self.lengths = np.empty(0, dtype=np.int64)
        self.pool = np.empty(0, dtype=np.uint64)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.bound:
            self.__init__(self.bound)
        own = [(t or "").split() for t in texts]
        stretches = [s for x in own for s in x]
        new = list(set(stretches).difference(self.known))
        if new:
            words = [_WORD.findall(s.lower()) for s in new]
            lengths = np.array([len(w) for w in words], dtype=np.int64)
            at = len(self.known)
            self.known.update(zip(new, range(at, at + len(new))))
            self.starts = np.r_[self.starts, len(self.pool) + np.cumsum(lengths) - lengths]
            self.lengths = np.r_[self.lengths, lengths]
            self.pool = np.r_[self.pool, np.array([xxhash.xxh64_intdigest(x) for w in words for x in w], dtype=np.uint64)]
        at = np.fromiter(map(self.known.__getitem__, stretches), dtype=np.int64, count=len(stretches))
        lengths = self.lengths[at]
        cuts = np.r_[0, np.cumsum([len(x) for x in own])]
        return self.pool[ragged(self.starts[at], lengths)], np.diff(np.r_[0, np.cumsum(lengths)][cuts])


def _seeds(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each position, and whether they lie in one text."""
    n = len(words)
    seed = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        m = max(0, n - j)
        seed[:m] = seed[:m] * _BASE + words[j:]
    left = np.repeat(np.cumsum(counts), counts) - np.arange(n)
    return seed ^ (seed >> np.uint64(29)), left >= k


def tiles(item: list[int], doc: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in doc, length) of the tiles."""
    marked_item, marked_doc, found = [False] * len(item), [False] * len(doc), []

    def runs(words, marked, size):
        """(place, hash) of each unmarked run of ``size`` words, the hash rolled on."""
        mod, base = (1 << 61) - 1, 1_000_003
        top, value, fresh = pow(base, size - 1, mod), 0, 0
        for i, w in enumerate(words):
            if marked[i]:
                value = fresh = 0
                continue
            if fresh == size:
                value = (value - words[i - size] * top) % mod
                fresh -= 1
            value = (value * base + w) % mod
            fresh += 1
            if fresh == size:
                yield i - size + 1, value

    size = max(min_match, min(len(item), len(doc), 32))
    while True:
        table: dict[int, list[int]] = {}
        for at, value in runs(item, marked_item, size):
            table.setdefault(value, []).append(at)
        matches, longest = [], 0
        for d, value in runs(doc, marked_doc, size):
            for i in table.get(value, ()):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and not (marked_item[i + n] or marked_doc[d + n]):
                    n += 1
                if n >= size:
                    longest = max(longest, n)
                    matches.append((-n, i, d))
        if longest > 2 * size:
            size = longest
            continue
        again = False
        for n, i, d in sorted(matches):
            span = range(-n)
            if any(marked_item[i + j] or marked_doc[d + j] for j in span):
                again = True  # a shorter rest of it may still be long enough
                continue
            for j in span:
                marked_item[i + j] = marked_doc[d + j] = True
            found.append((i, d, -n))
        if again:
            continue
        if size == min_match:
            return sorted(found)
        size = max(min_match, size // 2)


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """(doc_id, text_key, item_id, coverage, tiles) of each leak; tiles give word places in item and document."""
    spark = ship(docs.sparkSession)
    one = benchmark.filter(F.col(item_text).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(item_text).alias("t")).distinct()
    own_id = F.coalesce(F.concat(F.lit("i"), F.col("item_id").cast("string")), F.lit("n"))
    one = one.withColumn("item_key", F.concat_ws(":", own_id, text_key("t")))
    item_schema = pa.schema([("words", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64()))])

    # known words end with the task: kept in the worker, they would stand beside the tasks of all later stages
    def item_words(batches):
        hashes = WordHashes()
        for b in freeing(batches):
            texts = b.column(1).to_pylist()
            words, counts = hashes.of(texts)
            seeds, whole = _seeds(words, counts, min_match)
            cuts = np.r_[0, np.cumsum(counts)]
            signed, seeds = words.view(np.int64), seeds.view(np.int64)
            rows = batch(
                item_schema, words=[signed[a:z] for a, z in zip(cuts[:-1], cuts[1:])],
                seeds=[seeds[a:z][whole[a:z]] for a, z in zip(cuts[:-1], cuts[1:])],
            )
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *rows.columns], names=["item_id", "item_key", "words", "seeds"])

    id_type = one.schema["item_id"].dataType.simpleString()
    items = saved(one.mapInArrow(item_words, f"item_id {id_type}, item_key string, words array<long>, seeds array<long>"), "items")
    item_seeds = items.select("item_key", F.size("words").alias("n"), F.explode("seeds").alias("seed"))
    bits = np.zeros(SLOTS, dtype=bool)
    slots = item_seeds.select(F.pmod("seed", F.lit(SLOTS)).alias("s")).distinct().toArrow()  # SLOTS numbers at most
    bits[slots["s"].to_numpy()] = True
    shared = spark.sparkContext.broadcast(bits)
    doc_schema = pa.schema([("text_key", pa.string()), ("at", pa.list_(pa.int32())), ("words", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64()))])

    def doc_words(batches):
        table, hashes = shared.value, WordHashes()
        for b in freeing(batches):
            texts = b.column(1).to_pylist()
            for start in range(0, len(texts), 1_000):
                own = texts[start : start + 1_000]
                words, counts = hashes.of(own)
                seeds, whole = _seeds(words, counts, min_match)
                hit = np.flatnonzero(table[(seeds % np.uint64(SLOTS)).astype(np.int64)] & whole)
                if not len(hit):
                    continue
                covered = np.unique((hit[:, None] + np.arange(min_match)).ravel())
                cuts = np.r_[0, np.cumsum(counts)]
                of_hit, of_word = np.searchsorted(cuts, hit, "right") - 1, np.searchsorted(cuts, covered, "right") - 1
                docs_ = np.unique(of_hit)
                rows = batch(
                    doc_schema, text_key=[hashlib.md5(own[d].encode()).hexdigest() for d in docs_],
                    at=[(covered[of_word == d] - cuts[d]).astype(np.int32) for d in docs_],
                    words=[words[covered[of_word == d]].view(np.int64) for d in docs_],
                    seeds=[np.unique(seeds[hit[of_hit == d]].view(np.int64)) for d in docs_],
                )
                ids = b.column(0).slice(start, len(own)).take(pa.array(docs_))
                yield pa.RecordBatch.from_arrays([ids, *rows.columns], names=["doc_id", *doc_schema.names])

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    doc_type = given.schema["doc_id"].dataType.simpleString()
    found = given.mapInArrow(doc_words, f"doc_id {doc_type}, text_key string, at array<int>, words array<long>, seeds array<long>")
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_key")
    found = saved(found.withColumn("key", name), "seeded").dropDuplicates(["key"])
    enough = F.count("*") * min_match >= F.max("n") * min_coverage
    pairs = (
        found.select("key", F.explode("seeds").alias("seed")).join(item_seeds, "seed")
        .groupBy("key", "item_key").agg(enough.alias("enough")).filter("enough").select("key", "item_key")
    )
    joined = pairs.join(found.select("key", "doc_id", "text_key", "at", "words"), "key")
    joined = joined.join(items.select("item_key", "item_id", F.col("words").alias("item")), "item_key").select("doc_id", "text_key", "item_id", "at", "words", "item")

    def tile(batches):
        schema = pa.schema([("coverage", pa.float64()), ("tiles", pa.list_(pa.list_(pa.int32())))])
        for b in batches:
            cover, own = [], []
            for at, words, item in zip(*(b.column(i).to_pylist() for i in (3, 4, 5))):
                # a gap between kept words is a word that matches nothing
                spread, places = [], []
                for i, w in zip(at, words):
                    if places and i > places[-1] + 1:
                        spread.append(-1)
                        places.append(-1)
                    spread.append(w & 0xFFFFFFFFFFFFFFFF)
                    places.append(i)
                got = tiles([w & 0xFFFFFFFFFFFFFFFF for w in item], spread, min_match)
                own.append([[i, places[d], n] for i, d, n in got])
                cover.append(sum(n for _, _, n in got) / len(item))
            rows = batch(schema, coverage=cover, tiles=own)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *rows.columns], names=["doc_id", "text_key", "item_id", "coverage", "tiles"])

    out = joined.mapInArrow(tile, f"doc_id {doc_type}, text_key string, item_id {id_type}, coverage double, tiles array<array<int>>")
    return out.filter(F.col("coverage") >= min_coverage)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no benchmark item leaks into, with all their columns."""
    bad = leaks(docs, benchmark).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("i"), F.col("text_key").alias("k")).distinct()
    rows = docs.select(row_of(docs).alias("row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("i"), text_key("text").alias("k"))
    return rows.join(bad, ["i", "k"], "left_anti").select("row.*")
