"""Aggregates whose result does not depend on task order.

Money, volume and minutes are decimals, so their sums are exact.  A rounded mean
or rate is one decimal division of two exact sums; an unrounded one is a single
division of two doubles.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casting import as_column


def count_where(condition: Column) -> Column:
    """Number of rows where the condition holds; 0 when there is none."""
    return F.count_if(condition)


def null_if_zero(c) -> Column:
    return F.nullif(as_column(c), F.lit(0))


def total(c, precision: int, scale: int) -> Column:
    return F.sum(as_column(c)).cast(f"decimal({precision},{scale})")


def rounded(c, precision: int, scale: int) -> Column:
    return F.round(as_column(c), scale).cast(f"decimal({precision},{scale})")


def div_round(num, den, precision: int, scale: int, num_scale: int = 3) -> Column:
    """``num / den`` rounded half up, NULL for a zero denominator.

    The casts make Spark keep at least 11 decimals in the quotient before it is
    rounded to ``scale``.
    """
    n = as_column(num).cast(f"decimal(24,{num_scale})")
    d = F.nullif(as_column(den).cast("decimal(14,0)"), F.lit(0).cast("decimal(14,0)"))
    return F.round(n / d, scale).cast(f"decimal({precision},{scale})")


def mean_round(c, precision: int, scale: int, num_scale: int = 3) -> Column:
    """Mean of the non-null values of a decimal column, rounded half up."""
    return div_round(F.sum(as_column(c)), F.count(as_column(c)), precision, scale, num_scale)


def pct_round(part, whole, precision: int = 9, scale: int = 2) -> Column:
    return div_round(as_column(part) * 100, whole, precision, scale)


def ratio(num, den) -> Column:
    """Unrounded quotient as double, NULL for a zero denominator."""
    return F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))


def mean(c) -> Column:
    """Unrounded mean of a decimal or integer column from its exact sum."""
    return ratio(F.sum(as_column(c)), F.count(as_column(c)))
