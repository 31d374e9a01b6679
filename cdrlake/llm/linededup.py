"""Line dedup by winnowing over line hashes.

A text is its lines between line feeds; blank lines are not matched and stay.
1. Of each ``min_lines`` consecutive non-blank lines the smallest hash is the
   fingerprint, so any repeated run of so many lines shares one.  A line of ``long_line``
   characters or more is a window of its own too, as a passage may stand in one line.
2. Fingerprints that occur once in the corpus go: those that are shared set bits in a
   bitmap of fixed size, which is broadcast; it only saves work.  The other positions are
   joined on the fingerprint and the lines around it with the first position in the corpus,
   by document id and line; the first position of each is found with map-side minima.
3. Matched positions extend both ways: overlapping windows join to maximal runs.
4. Lines of runs that occurred before are deleted; the first occurrence stays.

So a line goes exactly if it lies in ``min_lines`` non-blank lines in a row that also
stand, in that order, at an earlier place, or if it is long and stands at an earlier
place.  A fingerprint in a third of all documents is dealt out by :func:`hot_join` and
costs one row per place, never a pair of documents.

Defined results: a null text has no lines and stays null; a text of which all lines
go becomes empty.  Rows equal in id and text count as one document.  Null ids come first.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freeing, hot_join, row_of, saved, ship, with_fields

MIN_LINES = 2
LONG_LINE = 100
SLOTS = 1 << 24


def _mixed(around: np.ndarray) -> np.ndarray:
    """A hash of the line hashes of each window, in order."""
    window = np.zeros(len(around), dtype=np.uint64)
    for j in range(around.shape[1]):
        window = (window ^ around[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        window ^= window >> np.uint64(32)
    return window


def _windows(docs: DataFrame, doc_id: str, text: str, min_lines: int, long_line: int) -> DataFrame:
    """(doc, key, fp, window, first, last): every window with its fingerprint; key is a hash of the text."""
    ship(docs.sparkSession)

    def numbered(x, i):
        """A line's number, hash and length, and another hash of a long one, which is a window by itself."""
        n = F.length(F.trim(x))
        return F.struct(i.alias("i"), F.xxhash64(x).alias("h"), n.alias("n"), F.when(n >= long_line, F.xxhash64(F.lit(1), x)).alias("again"))

    lines = F.filter(
        F.transform(F.split(F.col(text), "\n", -1), numbered),
        lambda x: x["n"] > 0,
    )
    rows = docs.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc"), F.xxhash64(text).alias("key"),
        F.transform(lines, lambda x: x["i"]).alias("i"), F.transform(lines, lambda x: x["h"]).alias("h"),
        F.transform(lines, lambda x: x["n"] >= long_line).alias("long"), F.transform(lines, lambda x: x["again"]).alias("again"),
    )

    def winnow(batches):
        names = ["doc", "key", "fp", "window", "first", "last"]
        for b in freeing(batches):
            size = b.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            index = b.column(2).flatten().to_numpy().astype(np.int64)
            hashes = b.column(3).flatten().to_numpy().view(np.uint64)
            long = np.flatnonzero(b.column(4).flatten().to_numpy(zero_copy_only=False))
            n = len(hashes)
            left = np.repeat(np.cumsum(size), size) - np.arange(n)
            at = np.flatnonzero(left >= min_lines)
            around = hashes[at[:, None] + np.arange(min_lines)]
            again = b.column(5).flatten().drop_null().to_numpy().view(np.uint64)
            window = np.r_[_mixed(around), again]
            # fingerprints of single lines are kept apart from those of windows
            least = np.r_[around.min(axis=1), ~hashes[long]]
            doc = pa.array(np.repeat(np.arange(len(size)), size)[np.r_[at, long]])
            columns = [b.column(0).take(doc), b.column(1).take(doc)]
            columns += [pa.array(x.view(np.int64)) for x in (least, window)]
            columns += [pa.array(index[np.r_[at, long]].astype(np.int32)), pa.array(index[np.r_[at + min_lines - 1, long]].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(winnow, "doc long, key long, fp long, window long, first int, last int")


def repeated_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, long_line: int = LONG_LINE
) -> DataFrame:
    """(doc, key, runs): the deleted runs (first and last line, from 0) of each document that has some."""
    windows = saved(_windows(docs, doc_id, text, min_lines, long_line), "windows")
    spread, whole = ["doc", "key", "first"], ["fp", "window"]
    shared = windows.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1")
    bits = np.zeros(SLOTS, dtype=bool)
    slots = shared.select(F.pmod("fp", F.lit(SLOTS)).cast("int").alias("s")).distinct().toArrow()  # SLOTS numbers at most
    bits[slots["s"].to_numpy()] = True
    table = docs.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little"))

    def of_shared(batches):
        packed = table.value
        for b in freeing(batches):
            slot = b.column(2).to_numpy() % SLOTS
            yield b.filter(pa.array((packed[slot >> 3] >> (slot & 7) & 1).astype(bool)))

    near = windows.mapInArrow(of_shared, windows.schema)
    place = F.struct("doc", "key", "first")
    earliest = near.groupBy(*whole).agg(F.min(place).alias("origin"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = hot_join(near, earliest, whole, spread).filter(~place.eqNullSafe(F.col("origin")))
    order = Window.partitionBy("doc", "key").orderBy("first")
    # runs that only touch are one; blank lines between lines of a run lie inside it
    opens = F.coalesce(F.col("first") > F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = (
        later.select("doc", "key", "first", "last").distinct()
        .withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(order))
        .groupBy("doc", "key", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    return runs.groupBy("doc", "key").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def cut(docs: DataFrame, doc_id: str, text: str, min_lines: int = MIN_LINES, long_line: int = LONG_LINE) -> DataFrame:
    """(row, runs, kept, n_removed) of every row of ``docs``: its columns, deleted runs and what is left of the text."""
    runs = repeated_runs(docs, doc_id, text, min_lines, long_line)
    there = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    left = docs.select(row_of(docs).alias("row"), there(doc_id).alias("d"), F.xxhash64(text).alias("k"))
    rows = left.join(runs.select(there("doc").alias("d"), F.col("key").alias("k"), "runs"), ["d", "k"], "left").select("row", "runs")

    def delete(batches):
        for b in freeing(batches):
            kept, removed = [], []
            for value, own in zip(b.column(0).field(text).to_pylist(), b.column(1).to_pylist()):
                n = 0
                if own:
                    lines, out, at = value.split("\n"), [], 0
                    for run in own:
                        gone = lines[run["first"] : run["last"] + 1]
                        blank = [x for x in gone if not x.strip(" ")]
                        n += len(gone) - len(blank)
                        out += lines[at : run["first"]] + blank
                        at = run["last"] + 1
                    value = "\n".join(out + lines[at:])
                kept.append(value)
                removed.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(kept, pa.string()), pa.array(removed, pa.int32())], names=["row", "runs", "kept", "n_removed"])

    return rows.mapInArrow(delete, with_fields(rows.schema, "kept string, n_removed int"))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_removed, n_runs, runs, kept_sha256) of every row."""
    rows = cut(docs, doc_id, text)
    return rows.select(
        F.col("row")[doc_id].alias("doc_id"), "n_removed", F.coalesce(F.size("runs"), F.lit(0)).alias("n_runs"),
        F.array_join(F.transform("runs", lambda r: F.concat_ws("-", r["first"].cast("string"), r["last"].cast("string"))), " ").alias("runs"),
        F.sha2(F.coalesce(F.col("kept"), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """All documents with repeated runs of lines cut from their texts."""
    rows = cut(docs, "doc_id", "text")
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents WHERE text IS NOT NULL),
filled AS (
  SELECT *, lead(line) OVER w AS line2, lead(pos) OVER w AS pos2 FROM lines WHERE trim(line) <> ''
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
windows AS (
  SELECT *, row_number() OVER (PARTITION BY line, line2 ORDER BY doc_id, pos) AS n FROM filled WHERE pos2 IS NOT NULL),
lengthy AS (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS n FROM lines WHERE length(trim(line)) >= {LONG_LINE}),
later AS (SELECT doc_id, pos, pos2 FROM windows WHERE n > 1 UNION ALL SELECT doc_id, pos, pos FROM lengthy WHERE n > 1),
opened AS (
  SELECT *, CASE WHEN pos > max(pos2) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              IS NOT FALSE THEN 1 ELSE 0 END AS opens FROM later),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM opened),
runs AS (SELECT doc_id, run, min(pos) AS first, max(pos2) AS last FROM numbered GROUP BY doc_id, run),
per_doc AS (
  SELECT doc_id, count(*) AS n_runs, list(first || '-' || last ORDER BY first) AS runs FROM runs GROUP BY doc_id),
gone AS (
  SELECT DISTINCT lines.doc_id, lines.pos FROM lines JOIN runs ON lines.doc_id = runs.doc_id
  AND lines.pos BETWEEN runs.first AND runs.last WHERE trim(line) <> ''),
kept AS (
  SELECT lines.doc_id, count(gone.pos) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY lines.pos) FILTER (WHERE gone.pos IS NULL), '') AS text
  FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.pos = gone.pos GROUP BY lines.doc_id)
SELECT d.doc_id, CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed, CAST(coalesce(n_runs, 0) AS INTEGER) AS n_runs,
       array_to_string(runs, ' ') AS runs, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN per_doc USING (doc_id)"""
