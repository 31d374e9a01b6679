"""Toxicity by the nearest labelled examples under TF-IDF cosine.

1. At most ``max_examples`` labelled rows, those with the smallest hash of the id, are the
   examples (a documented bound; the rows held out never are).
2. Terms are words and their stems of four and five letters that stand in at least
   ``MIN_SHARE`` of the examples, which bounds their number by the terms of a text over
   that share.  Inverse document frequencies come from all documents.  A term's weight in
   a text is (1 + ln tf) x (ln((1 + N) / (1 + df)) + 1); vectors have length one.
3. Examples with equal vectors are one entry with its count of labels.  Similar entries stand
   next to each other, in blocks; the index holds, for each term and block, the largest weight.
4. A search leaves out the blocks that cannot hold one of the ``NEIGHBOURS`` nearest any more,
   by their largest weights.  What it returns is exact: the order by cosine, then by entry.
5. Neighbours vote with count / distance^8, so a near copy decides.  Each example is searched
   without itself; how often votes of a height were right there, made monotone, turns a vote
   into a probability.  A unanimous vote of either kind counts as one example more.
   ``evidence`` names the nearest examples' documents.

Defined results: empty, null and term-free texts get the share of toxic examples and no
evidence; without examples every score is 0.  A document labelled more than once is toxic if
any label says so; rows of equal id and text count as examples each for itself.  A very long
text is one vector, made in one task's memory.  Extra columns and their names do not matter.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, fold, ragged, saved, ship, with_fields
from .encoding import column_slices

MAX_EXAMPLES = 5_000
MIN_SHARE = 0.01
NEIGHBOURS = 64
BLOCK = 64
#: terms whose weights are held as dense rows: those of the most entries
DENSE = 2_048
#: texts of a product of matrices
BATCH = 256
#: a neighbour's vote weighs its distance (1 - cosine, plus NEAR) to the power of -SHARP
NEAR, SHARP = 0.02, 8
#: bound of the error of a cosine in single precision
ERROR = 2e-4
#: entries that others gather around, so that blocks hold similar ones
PIVOTS = 64
_KNOWN = 300_000


def forms(word: str) -> list[str]:
    """The terms that a word stands for: itself and its stems of four and five letters."""
    return [word, *(f"{word[:n]}*" for n in (4, 5) if len(word) > n)]


def words(texts: pa.Array) -> pa.ListArray:
    """The lower-case words of each text; null has none."""
    plain = pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), ""))
    # a text that ends or begins with marks has empty words there, which are no term
    return pc.split_pattern(pc.replace_substring_regex(plain, r"[^\pL\pN_]+", " "), " ")


class Terms:
    """Vectors of Arrow text columns over known terms; words met before are remembered, up to a bound."""

    def __init__(self, names: list[str]):
        self.names = names
        self.ids: dict[str, int] | None = None

    def __reduce__(self):
        return Terms, (self.names,)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool: list[int] = []
        self.starts: list[int] = []
        self.sizes: list[int] = []

    def _slot(self, word: str) -> int:
        ids, n = self.ids, len(word)
        at = len(self.pool)
        if word in ids:
            self.pool.append(ids[word])
        if n > 4 and (stem := f"{word[:4]}*") in ids:
            self.pool.append(ids[stem])
            # a text with the longer stem has the shorter one as well, so it is at least as frequent
            if n > 5 and (stem := f"{word[:5]}*") in ids:
                self.pool.append(ids[stem])
        self.starts.append(at)
        self.sizes.append(len(self.pool) - at)
        self.known[word] = slot = len(self.starts) - 1
        return slot

    def vectors(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(bounds, terms, times) of runs of texts: those of text i are at bounds[i] .. bounds[i + 1]."""
        if self.ids is None:
            self.ids = {w: i for i, w in enumerate(self.names)}
            self._forget()
        size = max(1, len(self.names))
        for start, stop in column_slices(texts):
            if len(self.known) >= _KNOWN:
                self._forget()
            lists = words(texts.slice(start, stop - start))
            offsets = lists.offsets.to_numpy().astype(np.int64)
            coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
            offsets -= offsets[0]
            known, slot = self.known, self._slot
            slots = np.array([known[s] if s in known else slot(s) for s in coded.dictionary.to_pylist()], dtype=np.int64)
            every = slots[coded.indices.to_numpy()] if len(slots) else np.empty(0, dtype=np.int64)
            sizes = np.array(self.sizes, dtype=np.int64)[every]
            found = np.array(self.pool, dtype=np.int64)[ragged(np.array(self.starts, dtype=np.int64)[every], sizes)]
            # terms found in each text
            inside = np.r_[0, np.cumsum(sizes)][offsets]
            own, times = np.unique(np.repeat(np.arange(stop - start), np.diff(inside)) * size + found, return_counts=True)
            yield np.searchsorted(own, np.arange(stop - start + 1) * size), own % size, times


class Index:
    """Unit TF-IDF vectors of the entries: a block-max inverted index of the rarer terms, dense rows of the others."""

    def __init__(self, weight, term, tf, sizes, count, toxic, ids):
        """``weight`` of each term; the entries' terms and times one after the other, their numbers, labels and documents."""
        self.weight = np.asarray(weight, dtype=np.float64)
        sizes, term = np.asarray(sizes, dtype=np.int64), np.asarray(term, dtype=np.int32)
        starts = np.cumsum(sizes) - sizes
        unit = (1 + np.log(np.asarray(tf, dtype=np.float64))) * self.weight[term]
        if len(sizes):
            unit /= np.repeat(np.sqrt(np.add.reduceat(unit**2, starts)), sizes)
        order = self._beside(term, unit, starts, sizes)
        where = ragged(starts[order], sizes[order])
        self.term, self.unit, self.sizes = term[where], unit[where], sizes[order]
        self.count, self.toxic = (np.asarray(x, dtype=np.float64)[order] for x in (count, toxic))
        self.ids = [ids[i] for i in order]
        self.ready = False

    def _beside(self, term, unit, starts, sizes) -> np.ndarray:
        """An order in which entries stand with those that are nearest to the same pivot."""
        n = len(sizes)
        if n <= BLOCK:
            return np.arange(n)
        place, best, nearest = np.zeros(len(self.weight)), np.full(n, -1.0), np.zeros(n, dtype=np.int64)
        for number, p in enumerate(range(0, n, max(1, n // PIVOTS))):
            own = slice(starts[p], starts[p] + sizes[p])
            place[term[own]] = unit[own]
            cosine = np.add.reduceat(place[term] * unit, starts)
            place[term[own]] = 0.0
            closer = cosine > best
            best[closer], nearest[closer] = cosine[closer], number
        return np.lexsort((np.arange(n), -best, nearest))

    def _prepare(self) -> None:
        """Postings, each block's largest weights and dense rows, made by each worker from what it was sent."""
        n, size = len(self.sizes), len(self.weight)
        self.starts = np.cumsum(self.sizes) - self.sizes
        entry = np.repeat(np.arange(n, dtype=np.int32), self.sizes)
        order = np.argsort(self.term, kind="stable")
        number = np.bincount(self.term, minlength=size)
        self.cuts = np.r_[0, np.cumsum(number)]
        self.at, self.posted = entry[order], self.unit[order].astype(np.float32)
        often = np.argsort(-number, kind="stable")[:DENSE]
        self.row = np.full(size, -1)
        self.row[often] = np.arange(len(often))
        # a multiple of the block, so that blocks are rows of a reshaped array
        self.blocks = -(-n // BLOCK)
        self.dense = np.zeros((len(often), self.blocks * BLOCK), dtype=np.float32)
        for r, t in enumerate(often.tolist()):
            own = slice(self.cuts[t], self.cuts[t + 1])
            self.dense[r, self.at[own]] = self.posted[own]
        self.highest = np.zeros((size, self.blocks), dtype=np.float32)
        np.maximum.at(self.highest, (self.term, entry // BLOCK), self.unit.astype(np.float32))
        self.place = np.zeros(size)
        self.ready = True

    def nearest(
        self, bounds: np.ndarray, term: np.ndarray, times: np.ndarray, k: int = NEIGHBOURS
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(cosines, entries) of the k nearest entries with a positive cosine of each text, best first, exactly.

        Cosines over the frequent terms are one product of matrices.  A block whose largest of
        those and largest weights of the text's rarer terms do not reach the k-th of the
        former is left out; in the others the rarer terms' postings are added.  What may be
        among the k nearest within the error of single precision is computed once more.
        """
        if not self.ready:
            self._prepare()
        n = len(self.sizes)
        for low in range(0, len(bounds) - 1, BATCH):
            own = bounds[low : low + BATCH + 1]
            heads, texts = np.zeros((len(own) - 1, len(self.dense)), dtype=np.float32), []
            for i, (a, z) in enumerate(zip(own[:-1].tolist(), own[1:].tolist())):
                unit = (1 + np.log(times[a:z])) * self.weight[term[a:z]]
                unit /= np.sqrt((unit * unit).sum()) if z > a else 1.0
                row = self.row[term[a:z]]
                heads[i, row[row >= 0]] = unit[row >= 0]
                texts.append((term[a:z], unit, row < 0))
            cosines = heads @ self.dense
            reach = cosines.reshape(len(cosines), self.blocks, BLOCK).max(axis=2) if n else None
            for i, (words, unit, rare) in enumerate(texts):
                if not len(words) or not n:
                    yield np.empty(0), np.empty(0, dtype=np.int64)
                    continue
                near, tail, weight = cosines[i], words[rare], unit[rare].astype(np.float32)
                least = np.partition(near, -k)[-k] if len(near) > k else np.float32(0)
                live = reach[i] + weight @ self.highest[tail] >= least - 2 * ERROR
                first = self.cuts[tail]
                number = self.cuts[tail + 1] - first
                where = ragged(first, number)
                entry, added = self.at[where], np.repeat(weight, number) * self.posted[where]
                if not live.all():
                    inside = live[entry // BLOCK]
                    entry, added = entry[inside], added[inside]
                near += np.bincount(entry, added, len(near)).astype(np.float32)
                # entries of blocks left out have less than they could, and could not reach the k-th
                least = np.partition(near, -k)[-k] - 2 * ERROR if len(near) > k else np.float32(0)
                found = np.flatnonzero((near >= least) & (near > 0))
                found = found[live[found // BLOCK]]
                if not len(found):
                    yield np.empty(0), found
                    continue
                self.place[words] = unit
                where, sizes = ragged(self.starts[found], self.sizes[found]), self.sizes[found]
                exact = np.round(np.add.reduceat(self.place[self.term[where]] * self.unit[where], np.cumsum(sizes) - sizes), 9)
                self.place[words] = 0.0
                best = np.lexsort((found, -exact))[:k]
                yield exact[best], found[best]

    def votes(
        self, bounds: np.ndarray, term: np.ndarray, times: np.ndarray, labels: list[int] | None = None, k: int = NEIGHBOURS
    ) -> list[tuple[float, list[int]]]:
        """Each text's neighbours' share of toxic votes and the nearest examples' documents, or NaN and none.

        With ``labels`` the texts are examples, and none votes for itself: its entry is the
        first one, at a cosine of one.
        """
        out = []
        for i, (cosines, entries) in enumerate(self.nearest(bounds, term, times, k + (labels is not None))):
            count, toxic = self.count[entries], self.toxic[entries]
            if labels is not None and len(entries):
                count[0], toxic[0] = count[0] - 1, toxic[0] - labels[i]
                keep = count > 0
                cosines, entries, count, toxic = (x[keep][:k] for x in (cosines, entries, count, toxic))
            if not len(entries):
                out.append((float("nan"), []))
                continue
            power = (1 + NEAR - cosines) ** -SHARP
            out.append((float((power * toxic).sum() / (power * count).sum()), [self.ids[e] for e in entries[:3]]))
        return out


def monotone(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(heights, chances): steps of the monotone map from votes to the share of toxic ones, by pooling neighbours.

    Each step's share is drawn towards one half by one example, so that none is certain.
    """
    order = np.argsort(votes, kind="stable")
    steps: list[list[float]] = []  # lowest vote, highest vote, toxic, number
    for v, y in zip(votes[order].tolist(), labels[order].tolist()):
        steps.append([v, v, y, 1.0])
        while len(steps) > 1 and (steps[-2][1] == steps[-1][0] or steps[-2][2] * steps[-1][3] >= steps[-1][2] * steps[-2][3]):
            low, _, a, n = steps.pop(-2)
            steps[-1] = [low, steps[-1][1], steps[-1][2] + a, steps[-1][3] + n]
    heights = np.array([x for s in steps for x in s[:2]])
    chances = np.array([c for s in steps for c in [(s[2] + 0.5) / (s[3] + 1)] * 2])
    return heights, np.maximum.accumulate(chances) if len(chances) else chances


def examples_of(labels: DataFrame, doc_id: str, label: str, max_examples: int) -> DataFrame:
    """(id, toxic) of at most ``max_examples`` labelled documents."""
    marked = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    marked = marked.groupBy(F.col(doc_id).cast("long").alias("id")).agg((F.max(label) != 0).cast("long").alias("toxic"))
    return marked.orderBy(F.xxhash64("id"), "id").limit(max_examples)


def names_of(examples: DataFrame, min_share: float) -> list[str]:
    """The terms in at least that share of the examples' texts, in order."""

    def count(batches):
        schema = pa.schema([("term", pa.string()), ("n", pa.int64())])
        for b in batches:
            seen: Counter[str] = Counter()
            for own in words(b.column(0)).to_pylist():
                seen.update({f for w in set(own) if w for f in forms(w)})
            yield batch(schema, term=list(seen), n=list(seen.values()))

    least = max(2.0, min_share * examples.count())
    # a word's longer stem is only looked up where the shorter one is known
    found = examples.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # terms of a text / min_share of them at most
    return sorted(r["term"] for r in found.filter(F.col("n") >= least).select("term").collect())


def vectors_of(docs: DataFrame, text: str, keep: list[Column], shared) -> DataFrame:
    """The columns ``keep`` with ``term`` and ``tf`` of the known terms, stored: whole texts are read once for them."""
    rows = docs.select(*keep, F.col(f"`{text}`").alias("__text"))
    fields = rows.columns[:-1]

    def run(batches):
        for b in batches:
            at = 0
            for bounds, own, times in shared.value.vectors(b.column(len(fields))):
                n = len(bounds) - 1
                offsets = pa.array(bounds.astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (own, times)]
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(at, n) for i in range(len(fields))), *lists], names=[*fields, "term", "tf"])
                at += n

    return saved(rows.mapInArrow(run, with_fields(rows.drop("__text").schema, "term array<int>, tf array<int>")), "vectors")


def _flat(term: pa.ListArray, tf: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, terms, times) of list columns."""
    sizes = term.value_lengths().to_numpy(zero_copy_only=False)
    return np.r_[0, np.cumsum(sizes)].astype(np.int64), term.flatten().to_numpy(), tf.flatten().to_numpy()


def frequencies(vectors: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Number of documents, and of those that have each of the terms."""

    def count(batches):
        df, n = np.zeros(size + 1, dtype=np.int64), 0
        for b in batches:
            df[:size] += np.bincount(b.column(0).flatten().to_numpy(), minlength=size)[:size]
            n += b.num_rows
        df[size] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["t", "n"])

    found = vectors.select("term").mapInArrow(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()  # a number per term
    df = np.zeros(size + 1)
    df[found["t"].to_numpy()] = found["n"].to_numpy()
    return int(df[size]), df[:size]


def build_index(examples: DataFrame, weight: np.ndarray) -> Index:
    """The index of the examples (id, toxic, term, tf)."""
    key = F.md5(F.concat_ws("|", F.array_join("term", ","), F.array_join("tf", ",")).cast("binary"))
    classes = examples.filter(F.size("term") > 0).groupBy(key.alias("key")).agg(
        F.count("*").alias("n"), F.sum("toxic").alias("bad"), F.min("id").alias("id"), F.first("term").alias("term"), F.first("tf").alias("tf")
    )
    # as many rows as examples at most, of as many terms as there are at most
    found = classes.toArrow().sort_by("key")
    bounds, term, tf = _flat(*(found[c].combine_chunks() for c in ("term", "tf")))
    return Index(weight, term, tf, np.diff(bounds), found["n"].to_numpy(), found["bad"].to_numpy(), found["id"].to_pylist())


def calibration(examples: DataFrame, index, k: int = NEIGHBOURS) -> tuple[float, np.ndarray, np.ndarray]:
    """The share of toxic examples, and the map from votes to chances, by searching each example without itself."""
    schema = pa.schema([("vote", pa.float64()), ("toxic", pa.int64())])

    def votes(batches):
        for b in batches:
            out = index.value.votes(*_flat(b.column(1), b.column(2)), labels=b.column(0).to_pylist(), k=k)
            yield batch(schema, vote=[v for v, _ in out], toxic=b.column(0))

    table = examples.select("toxic", "term", "tf").mapInArrow(votes, "vote double, toxic long").toArrow()  # two numbers an example
    vote, toxic = table["vote"].to_numpy(), table["toxic"].to_numpy().astype(float)
    known = ~np.isnan(vote)
    if not len(toxic):
        return 0.0, np.empty(0), np.empty(0)
    return float(toxic.mean()), *monotone(np.r_[vote[known], 0.0, 1.0], np.r_[toxic[known], 0.0, 1.0])


def score(vectors: DataFrame, index, chances: tuple[float, np.ndarray, np.ndarray], k: int = NEIGHBOURS) -> DataFrame:
    """``score``, ``predicted`` and ``evidence`` in place of ``term`` and ``tf``."""
    out = vectors.drop("term", "tf")
    fields = out.columns
    base, heights, shares = chances

    def run(batches):
        for b in batches:
            found = index.value.votes(*_flat(b.column(len(fields)), b.column(len(fields) + 1)), k=k)
            votes = np.array([v for v, _ in found], dtype=float)
            scores = np.full(len(votes), base)
            known = ~np.isnan(votes)
            if len(heights):
                scores[known] = np.interp(votes[known], heights, shares)
            columns = [b.column(i) for i in range(len(fields))]
            more = [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array([e for _, e in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns + more, names=[*fields, "score", "predicted", "evidence"])

    return vectors.select(*fields, "term", "tf").mapInArrow(run, with_fields(out.schema, "score double, predicted int, evidence array<bigint>"))


def toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    max_examples: int = MAX_EXAMPLES, min_share: float = MIN_SHARE, neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every row of ``docs``."""
    spark = ship(docs.sparkSession)
    held = F.coalesce(fold(doc_id, 5) == 0, F.lit(False))
    marked = saved(examples_of(labels.filter(~held), doc_id, label, max_examples), "examples")
    # max_examples rows of two numbers at most
    chosen = F.broadcast(marked)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(chosen, "id").select("text")
    names = names_of(saved(texts, "example-texts"), min_share)
    vectors = vectors_of(docs, text, [F.col(doc_id).alias("doc_id"), held.alias("held_out")], spark.sparkContext.broadcast(Terms(names)))
    number, df = frequencies(vectors, len(names))
    examples = vectors.select(F.col("doc_id").cast("long").alias("id"), "term", "tf").join(chosen, "id")
    examples = saved(examples, "example-vectors")
    index = spark.sparkContext.broadcast(build_index(examples, np.log((1 + number) / (1 + df)) + 1))
    return score(vectors, index, calibration(examples, index, neighbours), neighbours)
