"""Trailing windows seen from one or many as-of dates."""

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.literals import day, day_array


def as_dates(as_of: date | list[date]) -> list[date]:
    return sorted({as_of} if isinstance(as_of, date) else set(as_of))


def trailing(column: str, as_of: date, days: int) -> str:
    """Rows of the last ``days`` days, both ends included."""
    return f"{column} BETWEEN {day(as_of - timedelta(days=days))} AND {day(as_of)}"


def until(df: DataFrame, column: str, as_of: date | None) -> DataFrame:
    """Rows up to ``as_of``: what was known on that day. The bound reaches the scan and prunes date partitions."""
    return df if as_of is None else df.where(f"{column} <= {day(as_of)}")


def newest(df: DataFrame, column: str, as_of: date | None = None) -> DataFrame:
    """Rows of the newest date at or before ``as_of``; the date is a scalar subquery, so it prunes partitions."""
    known = until(df, column, as_of)
    return known.where(F.col(column) == known.agg(F.max(column)).scalar())


def spread(df: DataFrame, as_of: list[date], seen: str) -> DataFrame:
    """Copy each row to every as-of date ``d`` for which ``seen`` holds, as column ``as_of``.

    The dates are a literal array, so there is neither a range join nor a cross join.
    """
    return df.selectExpr("*", f"explode(filter({day_array(as_of)}, d -> {seen})) AS as_of")


def spread_to_as_of(df: DataFrame, column: str, as_of: list[date], days: int) -> DataFrame:
    """Copy each row to every as-of date whose trailing window holds it.

    The outer range filter reaches the scan and prunes date partitions.
    """
    inside = df.where(f"{column} BETWEEN {day(as_of[0] - timedelta(days=days))} AND {day(as_of[-1])}")
    if len(as_of) == 1:
        return inside.selectExpr("*", f"{day(as_of[0])} AS as_of")
    return spread(inside, as_of, f"{column} BETWEEN date_sub(d, {days}) AND d")
