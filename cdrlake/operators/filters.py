"""Row filters shared by Silver, alerts and reports."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import as_column
from ..functions.codes import ALERT_EVENTS


def window(column: str, start, end) -> Column:
    """``start <= column <= end``; ISO date text compares like dates."""
    return F.col(column).between(F.lit(start), F.lit(end))


def in_window(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows whose column lies in the window, both ends included."""
    return df.where(window(column, start, end))


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where none of the columns is NULL."""
    return df.dropna(subset=list(columns))


def active(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_active") == 1)


def alert_predicate(churn_risk="churn_risk", event_type="event_type") -> Column:
    return (as_column(churn_risk) == "High") & as_column(event_type).isin(ALERT_EVENTS)


def slice_by(df: DataFrame, **equals) -> DataFrame:
    """Report slicers: column = value, or column in list; ``None`` means no choice."""
    conditions = [
        F.col(name).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(name) == value
        for name, value in equals.items()
        if value is not None
    ]
    return df.where(reduce(and_, conditions)) if conditions else df


def rls(df: DataFrame, grants: DataFrame, role: str) -> DataFrame:
    """Rows of the regions granted to a role; ``grants`` holds (role, region).

    A semi join: the grants side is tiny and Spark broadcasts it by its size.
    """
    allowed = grants.where(F.col("role") == role).select("region")
    return df.join(allowed, "region", "left_semi")
