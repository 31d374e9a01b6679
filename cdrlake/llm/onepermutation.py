"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Shingles are five words (fewer words: the whole sequence).  Each shingle is hashed
once; the upper bits name one of 128 bins, and the smallest hash of a bin is its value.
An empty bin copies a bin that has shingles: the first one in a pseudo-random order
of all bins that depends on the empty bin alone (optimal densification).  Of each
value the lowest 8 bits are stored.  Unequal values agree in those with probability
1/256, which the likeness is corrected for.

Defined results: null texts count as empty; a text without words has a constant
fingerprint.  A table of one row has itself as its next document.  Rows of null id
come last in descending order, rows of equal id in the order of a hash of the text.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 128
BITS = 8
SHINGLE = 5
_SHIFT = 64 - 7


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def packed(text: Column, shingle: int = SHINGLE) -> Column:
    """The low bits of the bins' values, as an array of 128 shorts."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    shingles = _let(
        hashed,
        lambda w: F.when(
            F.size(w) >= shingle,
            F.transform(F.sequence(F.lit(0), F.size(w) - shingle), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)])),
        ).otherwise(F.array(F.xxhash64(w))),
    )
    bin_of = lambda x: F.shiftrightunsigned(x, _SHIFT).cast("int")
    # in sorted order a bin's smallest value stands where a new bin begins
    least = _let(F.sort_array(shingles), lambda s: F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1)))))
    low = (1 << BITS) - 1
    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    # a bin and its low bits in one number
    own = lambda v: F.transform(v, lambda x: F.shiftleft(bin_of(x).cast("long"), BITS) + x.bitwiseAND(low))
    order = lambda j, x: F.xxhash64(j, bin_of(x)).bitwiseAND(~low).bitwiseOR(x.bitwiseAND(low))
    copied = lambda v: F.transform(
        F.array_except(every, F.transform(v, bin_of)),
        lambda j: F.shiftleft(j.cast("long"), BITS) + F.array_min(F.transform(v, lambda x: order(j, x))).bitwiseAND(low),
    )
    bins = _let(least, lambda v: F.sort_array(F.concat(own(v), copied(v))))
    return F.transform(bins, lambda x: x.bitwiseAND(low).cast("short"))


def as_text(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: F.lpad(F.lower(F.hex(x.cast("long"))), BITS // 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of the shingle sets of two fingerprints, corrected for chance, 0 to 1."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(BINS))
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))


def with_next(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` (id, text, fp) with ``next_text`` and ``next_fp`` of the next row in descending id; the last row's is the first.

    Ids fall into ranges of about equal size; the row that follows a range is added to it
    as a helper row.  Texts move once, in one shuffle.
    """
    ids = rows.select("id")
    cuts = ids.agg(F.percentile_approx("id", [i / buckets for i in range(1, buckets)] or [0.5], 10_000)).first()[0] or []
    bounds = sorted(set(cuts))
    bucket = F.coalesce(F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b < F.col("id"))), F.lit(-1)) if bounds else F.coalesce(F.col("id") * 0, F.lit(-1)).cast("int")
    bucket = F.when(F.col("id").isNull(), F.lit(-1)).otherwise(bucket)
    # a row per range: its greatest id comes first in it
    firsts = sorted((r["b"], r["top"]) for r in ids.groupBy(bucket.alias("b")).agg(F.max("id").alias("top")).collect())
    above = [(top, firsts[(k + 1) % len(firsts)][0]) for k, (_, top) in enumerate(firsts)]
    spark = rows.sparkSession
    helpers = spark.createDataFrame(above, "top long, target int")
    joined = rows.join(F.broadcast(helpers), F.col("id").eqNullSafe(F.col("top")), "left")
    own = F.struct(bucket.alias("b"), F.lit(False).alias("helper"))
    more = F.struct(F.col("target").alias("b"), F.lit(True).alias("helper"))
    placed = joined.withColumn("place", F.explode(F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, more))))
    order = Window.partitionBy("place.b").orderBy("place.helper", F.desc("id"), F.desc(F.xxhash64("text")))
    led = placed.select("id", "text", "fp", "place", F.lead("text").over(order).alias("next_text"), F.lead("fp").over(order).alias("next_fp"))
    return led.filter(~F.col("place.helper")).drop("place")


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has the last third of the code points replaced by the beginning of
    the next document in descending order of the ids.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), given.alias("text"), packed(given).alias("fp"))
    buckets = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    led = with_next(rows, min(buckets, 2_000))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    led = led.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third)))
    led = led.withColumn("edited_fp", packed(F.col("edited")))
    return led.select(
        F.col("id").alias("doc_id"), n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
