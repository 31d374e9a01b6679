"""Type conversion that yields NULL instead of failing under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
EVENT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"  # the Z is a literal, not an offset
#: Texts that a cast reads as the two formats do, in a fraction of the time.
PLAIN = {
    DATE_FORMAT: r"^(?!0000)\d{4}-\d{2}-\d{2}\z",
    TIMESTAMP_FORMAT: r"^(?!0000)\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z",
}


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parsed(c, fmt: str, kind: str) -> Column:
    text, formatted = as_column(c), F.try_to_timestamp(as_column(c), F.lit(fmt)).cast(kind)
    if fmt not in PLAIN:
        return formatted
    return F.when(text.cast("string").rlike(PLAIN[fmt]), text.try_cast(kind)).otherwise(formatted)


def to_ts(c, fmt: str = TIMESTAMP_FORMAT) -> Column:
    return _parsed(c, fmt, "timestamp")


def to_d(c, fmt: str = DATE_FORMAT) -> Column:
    return _parsed(c, fmt, "date")


def money(c, precision: int, scale: int) -> Column:
    """Exact decimal; values that do not fit become NULL."""
    return as_column(c).try_cast(f"decimal({precision},{scale})")


def money_or_zero(c, precision: int, scale: int) -> Column:
    """Like :func:`money` with NULL as 0, and still a decimal.

    A double zero would widen the column to double, and sums of doubles depend on
    task order.
    """
    kind = f"decimal({precision},{scale})"
    return F.coalesce(as_column(c).try_cast(kind), F.lit(0).cast(kind))


def zero_if_null(c, zero=0.0) -> Column:
    return F.coalesce(as_column(c), F.lit(zero))


def minutes(seconds) -> Column:
    """Seconds as minutes with two decimals.

    ``n/60`` never falls on a tie at the third decimal, so rounding the double is
    exact and the cast only restores the decimal type.
    """
    return F.round(as_column(seconds) / F.lit(60.0), 2).cast("decimal(12,2)")
