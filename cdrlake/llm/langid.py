"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every character that is not a letter counts as a space, letters are lower-cased.
All 1-, 2- and 3-grams of a text fall into ``buckets`` hash buckets.  Each task
counts its own texts, Spark sums the counts, and the matrix of log probabilities
(languages x buckets, both bounded) goes to the tasks, which score batches in numpy.

Defined results: a null text or one without letters gives ``und`` with score 0, and
so does every text if there is nothing to learn from.  Rows with a null language or
id teach nothing; a null id is not held out.  Ties go to the alphabetically first
language.  Repeated rows count and are scored each for itself.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, fold, freeing, ragged, row_of, ship, text_slices, with_fields

BUCKETS = 1 << 14
MAX_LANGUAGES = 500
#: Bound of the labelled rows that the classifier is fitted on.
MAX_TRAINING = 20_000
ORDERS = 3
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_SPACE = 32


@lru_cache
def _letters() -> np.ndarray:
    """Code point to lower-case letter, or to a space."""
    table = np.full(0x110000, _SPACE, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low[0])
    return table


def _grams(texts: list[str], buckets: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(texts, first gram of each, buckets as ORDERS rows), with letters kept apart as has-letter flags."""
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    pad = "\0" * (ORDERS - 1)
    for run in text_slices(texts):
        joined = "".join((texts[i] or "") + pad for i in run)
        raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = _letters()[raw]
        ends = np.cumsum([len(texts[i] or "") + ORDERS - 1 for i in run])
        hashed = np.empty((ORDERS, len(codes)), dtype=np.uint32)
        mixed = np.zeros(len(codes), dtype=np.uint32)
        for n in range(ORDERS):
            mixed[: len(codes) - n] += codes[n:] * _FACTORS[n]
            hashed[n] = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)) >> shift
        yield run, np.stack([np.r_[0, ends[:-1]], ends - (ORDERS - 1)], axis=1), hashed, codes != _SPACE


def train(
    docs: DataFrame, doc_id: str, text: str, lang: str, buckets: int = BUCKETS, max_rows: int = MAX_TRAINING
) -> tuple[list[str], np.ndarray]:
    """Languages and their matrix (buckets x languages) of log probabilities, the last row being the priors.

    The model is fitted on about ``max_rows`` labelled rows, picked by a hash of the
    id; all of them where there are fewer.
    """
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for b in freeing(batches):
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            by_lang: dict[str, list[str]] = {}
            for t, k in zip(texts, langs):
                by_lang.setdefault(k, []).append(t)
            for k, own in by_lang.items():
                total = counts.setdefault(k, np.zeros(buckets + 1, dtype=np.int64))
                total[buckets] += len(own)
                for _, bounds, hashed, _ in _grams(own, buckets):
                    keep = np.zeros(hashed.shape[1] + 1, dtype=np.int8)
                    np.add.at(keep, bounds[:, 0], 1)
                    np.add.at(keep, bounds[:, 1], -1)
                    inside = np.cumsum(keep[:-1]).astype(bool)
                    for n in range(ORDERS):
                        total[:buckets] += np.bincount(hashed[n][inside], minlength=buckets)
        for k, total in counts.items():
            at = np.flatnonzero(total)
            yield batch(schema, lang=[k] * len(at), bucket=at.astype(np.int32), n=total[at])

    ship(docs.sparkSession)
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(doc_id).isNotNull())
    share = min(1.0, max_rows / max(1, labelled.select(doc_id).count()))
    learned = labelled.filter(F.col(text).isNotNull())
    if share < 1:  # of 2^63 hashes, so that a small share of very many rows is not none
        learned = learned.filter(F.shiftrightunsigned(F.xxhash64(doc_id), 1) < F.lit(int(share * 2**63)))
    learned = learned.select(text, lang)
    rows = (
        learned.mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    totals = rows.filter(F.col("bucket") == buckets).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["lang"] for r in totals]
    model = np.zeros((buckets + 1, len(languages)))
    if languages:
        index = {k: i for i, k in enumerate(languages)}
        table = rows.toArrow()
        where = np.array([index[k] for k in table["lang"].to_pylist()])
        model[table["bucket"].to_numpy(), where] = table["n"].to_numpy()
        model[:buckets] = np.log(model[:buckets] + 0.5) - np.log(model[:buckets].sum(axis=0) + 0.5 * buckets)
        model[buckets] = np.log(model[buckets] / model[buckets].sum())
    return languages, model


def weighed(hashed: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sparse counts of each text's buckets times the matrix.

    A text's memory is bounded by its different buckets, however long it is.
    """
    buckets = len(table)
    if len(bounds) == 1:
        counts = np.bincount(hashed[bounds[0, 0] : bounds[0, 1]], minlength=buckets)
        at = np.flatnonzero(counts)
        return counts[at].astype(float)[None, :] @ table[at]
    sizes = bounds[:, 1] - bounds[:, 0]
    own = np.repeat(np.arange(len(bounds)), sizes) * buckets + hashed[ragged(bounds[:, 0], sizes)]
    own, counts = np.unique(own, return_counts=True)
    firsts = np.searchsorted(own, np.arange(len(bounds)) * buckets)
    return np.add.reduceat(counts[:, None] * table[own % buckets], firsts, axis=0)


def predict(docs: DataFrame, text: str, model: tuple[list[str], np.ndarray], keep: list[Column]) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``, the posterior probability of that language."""
    spark = ship(docs.sparkSession)
    languages, _ = model
    shared = spark.sparkContext.broadcast(model[1])
    rows = docs.select(*keep, F.col(text).alias("__text"))
    out = rows.drop("__text")
    fields = out.columns

    def score(batches):
        table = shared.value
        buckets = table.shape[0] - 1
        for b in freeing(batches):
            texts = b.column(len(fields)).to_pylist()
            pred, prob = ["und"] * len(texts), np.zeros(len(texts))
            for run, bounds, hashed, letters in _grams(texts, buckets) if languages else ():
                full = np.flatnonzero(bounds[:, 1] > bounds[:, 0])
                if not len(full):
                    continue
                cuts = bounds[full].ravel()
                sums = np.tile(table[buckets], (len(full), 1))
                for n in range(ORDERS):
                    sums += weighed(hashed[n], bounds[full], table[:buckets])
                known = np.add.reduceat(letters, cuts, dtype=np.int64)[::2] > 0
                best = sums.argmax(axis=1)
                p = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                for i in np.flatnonzero(known):
                    pred[run[full[i]]], prob[run[full[i]]] = languages[best[i]], p[i]
            columns = [b.column(i) for i in range(len(fields))] + [pa.array(pred), pa.array(prob)]
            yield pa.RecordBatch.from_arrays(columns, names=[*fields, "lang_pred", "score"])

    return rows.mapInArrow(score, with_fields(out.schema, "lang_pred string, score double"))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learned from the rows that are not held out."""
    held = F.coalesce(fold(doc_id, 4) == 2, F.lit(False))
    model = train(docs.filter(~held), doc_id, text, lang)
    return predict(docs, text, model, [F.col(doc_id).alias("doc_id"), held.alias("held_out")])


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The documents with a language: ``und`` and predictions below ``min_score`` go, all columns stay.

    ``min_score`` is below any score of a majority decision, so only texts without
    letters, or that three or more languages share, are rejected.
    """
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = train(docs.filter(~held), "doc_id", "text", "lang")
    scored = predict(docs, "text", model, [row_of(docs).alias("__row")])
    return scored.filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select("__row.*")
