"""Deterministic duplicate removal."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _CONTENT = "__rank", "__content"


def _ordering(columns) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c).asc_nulls_last() for c in columns]


def keep_first(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """One row per key (NULL is a key too): the first by ``order_by``.

    Rows that are equal there are told apart by a hash of all their columns, so equal
    inputs give equal outputs; the columns themselves need not be sorted, nor shuffled
    where the caller does not use them.  Spark turns the rank limit into a group limit
    below the shuffle: a task sends one row per key, however many copies of a key it holds.
    The hash in front of the keys lets the sorts decide on an 8-byte prefix; ids share
    their first characters, so the key text alone would be compared in full each time.
    """
    content = df.withColumn(_CONTENT, F.xxhash64(*df.columns))
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*_ordering([*order_by, _CONTENT]))
    ranked = content.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK, _CONTENT)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
