"""A corpus pipeline: each stage's result is written as Parquet and is the next one's documents."""

from pyspark.sql import DataFrame, SparkSession

from cdrlake.llm import decontam, langid, linededup, pieces, simhash
from cdrlake.llm.common import read_table, saved, ship
from cdrlake.llm.queries import PIECES


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return langid.keep_identified(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with later repeats of runs of lines cut out."""
    return linededup.deduplicated(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    return decontam.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with sampled pieces, and the text decoded from them."""
    return pieces.encoded_documents(docs, PIECES)


STAGES = [
    ("language id", identified),
    ("line dedup", without_repeated_lines),
    ("near-dedup", one_of_near_duplicates),
    ("decontamination", decontaminated),
    ("pieces", encoded),
]

#: Classifier, SimHash and sampling are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return saved(STAGES[-1][1](spark, docs, sf_dir), "pieces")
