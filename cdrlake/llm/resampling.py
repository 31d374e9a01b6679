"""Target-distribution importance resampling.

Documents are drawn so that their words look like those of a target table.  Features are
runs of consecutive words, hashed into a fixed number of buckets.  A bucket's gain is the
log ratio of its smoothed shares in target and corpus, in whole thousandths; a document's
weight is the sum over its features, and its score adds Gumbel noise seeded by its id, so
that the highest scores are a draw without replacement in proportion to the weights.

The scores are made in numpy arrays and stored.  The cutoff is found by bracketing: a
quantile sketch proposes a range of scores, exact counts of what lies above and inside
validate it or widen it, and only rows inside are sorted.  The order of the drawn rows
comes from a range-partitioned sort; no task or driver holds more than a partition.

Defined results: a null text has no words, and weight 0.  A null id counts as an empty one in
the noise and comes after all others in ties; repeated rows are scored and drawn each for
itself.  A very long text is scored whole, in one task's memory.  An empty corpus or target
gives empty counts, not an error.  Columns other than id and text are not read, and their
names cannot clash.
"""

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, saved, ship

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
#: half the first bracket's width, as a share of the rows
MARGIN = 0.005
#: different words whose buckets a task remembers
_KNOWN = 600_000

_WORD = [*b"0123456789", *b"abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]
#: lower case for A-Z, a space for what is not part of a word
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _WORD else 32 for c in range(256))


class _Buckets(dict):
    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _runs(own: list[bytes], longest: int) -> Iterator[bytes]:
    """All runs of 2 to ``longest`` words, joined by a space."""
    return (b" ".join(own[i : i + n]) for n in range(2, longest + 1) for i in range(len(own) - n + 1))


def features(texts: list[str | None], of: dict[bytes, int], longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features one text after the other, and each text's numbers of features and of words."""
    codes, counts, lengths = [], [], []
    for text in texts:
        own = words(text)
        found = list(map(of.__getitem__, own if longest == 1 else chain(own, _runs(own, longest))))
        codes.append(np.array(found, dtype=np.int64))
        counts.append(len(found))
        lengths.append(len(own))
    return np.concatenate(codes) if codes else np.empty(0, dtype=np.int64), np.array(counts, dtype=np.int64), np.array(lengths, dtype=np.int64)


def bucket_counts(rows: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n) over all features of all texts; each task sends one row a bucket at most."""
    ship(rows.sparkSession)
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = _Buckets(buckets), np.zeros(buckets, dtype=np.int64)
        for b in batches:
            total += np.bincount(features(b.column(0).to_pylist(), of, longest)[0], minlength=buckets)
        found = np.flatnonzero(total)
        yield batch(schema, bucket=found, n=total[found])

    return rows.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of each bucket, in thousandths; the driver gets two rows a bucket at most."""

    def dense(counts: DataFrame) -> list[int]:
        found = {r["bucket"]: r["n"] for r in counts.collect()}
        return [found.get(k, 0) for k in range(buckets)]

    of_corpus, of_target = dense(corpus), dense(target)
    s, t = float(sum(of_corpus) + buckets), float(sum(of_target) + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(of_corpus, of_target)], dtype=np.int64)


def noise(seed: int, doc_id: object) -> int:
    """Gumbel noise of a document, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score) of every row."""
    spark = ship(docs.sparkSession)
    table = spark.sparkContext.broadcast(
        gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, text, buckets, longest), buckets)
    )  # one number a bucket
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_features", "n_words", "weight", "score"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Buckets(buckets)
        for b in batches:
            names = b.column(0).to_pylist()
            codes, counts, lengths = features(b.column(1).to_pylist(), of, longest)
            sums = np.r_[0, np.cumsum(table.value[codes])]
            ends = np.r_[0, np.cumsum(counts)]
            weights = sums[ends[1:]] - sums[ends[:-1]]
            drawn = np.array([noise(seed, name) for name in names], dtype=np.int64)
            yield batch(schema, doc_id=names, n_features=counts, n_words=lengths, weight=weights, score=weights + drawn)

    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("d"), F.col(f"`{text}`").alias("t"))
    return own.mapInArrow(run, "doc_id long, n_features long, n_words long, weight long, score long")


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place, from 1, in ``order``: ranges are sorted in parallel and numbered by their sizes."""
    spot = "__spot"
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(spot, F.monotonically_increasing_id())
    ranged = saved(ranged, "ranked")
    part = F.shiftright(spot, 33)
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    joined = ranged.withColumn("__part", part).join(F.broadcast(sizes), "__part")
    return joined.withColumn(name, F.col("__before") + F.col(spot).bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__part", "__before", spot)



def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id")]


def bracket(eligible: DataFrame, n: int, k: int, margin: float = MARGIN) -> tuple[int, int, int]:
    """Scores (low, high) between which the k-th highest of n lies, and the number of rows above ``high``.

    A sketch proposes them; exact counts show whether the k-th is inside, and on a miss that
    side is moved outwards, to the extreme score in the end.
    """
    below, above = margin, margin
    while True:
        at = [max(0.0, 1 - k / n - below), min(1.0, 1 - k / n + above)]
        found = eligible.agg(F.percentile_approx("score", at, 10_000).alias("q"), F.min("score").alias("least"), F.max("score").alias("most")).first()
        low = found["q"][0] if at[0] > 0 else found["least"]
        high = found["q"][1] if at[1] < 1 else found["most"]
        over, inside = eligible.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if over < k <= over + inside:
            return low, high, over
        below, above = (below * 4, above) if over + inside < k else (below, above * 4)


def resampled(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, margin: float = MARGIN) -> tuple[DataFrame, DataFrame]:
    """The drawn rows of ``scores``, and the others.

    Drawn are floor(percent * N / 100) of the N rows with ``least_words`` words: those of the
    highest scores, of equal ones those of the smaller id.
    """
    eligible = scores.filter(F.col("n_words") >= least_words)
    n = eligible.count()
    k = percent * n // 100
    if k == 0:
        return scores.limit(0), scores
    low, high, over = bracket(eligible, n, k, margin)
    fits, score = F.col("n_words") >= least_words, F.col("score")
    inside = ranked(scores.filter(fits & score.between(low, high)), _order(), "__place")
    drawn = scores.filter(fits & (score > high)).union(inside.filter(F.col("__place") <= k - over).drop("__place"))
    others = scores.filter(~fits | (score < low)).union(inside.filter(F.col("__place") > k - over).drop("__place"))
    return drawn, others


def resample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """Every document's (doc_id, n_features, weight, score, rank); rank is null for those that were not drawn."""
    drawn, others = resampled(saved(scored(docs, target, **settings), "scores"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked(drawn, _order()).select(*columns, "rank").union(others.select(*columns, F.lit(None).cast("long").alias("rank")))
