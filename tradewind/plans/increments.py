"""Window queries over new days only.

The daily momentum queries look back at most ``LOOK_BACK`` rows of a category. So the last rows of each category before
the new days, the tail, stand for all of history: the query runs over the tail and the new days, and the new days' rows
of its result are those of a run over everything.
"""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.literals import day
from tradewind.operators.keyed import top_per_key
from tradewind.plans import windows

LOOK_BACK = 7
_DATE = "snapshot_date"


@dataclass(frozen=True)
class Momentum:
    """A momentum query in its two steps: signal rows to one row per category and day, and those to the result."""

    table: str
    daily: Callable[[DataFrame], DataFrame]
    windowed: Callable[[DataFrame], DataFrame]


MOMENTUM = {
    "wf_sell_through_delta": Momentum("category_trends", windows.listing_days, windows.sell_through_deltas),
    "wf_moving_avg": Momentum("category_trends", windows.listing_days, windows.moving_averages),
    "wf_interest_momentum": Momentum("search_signals", windows.interest_days, windows.interest_changes),
    "wf_buzz_momentum": Momentum("social_buzz", windows.daily_mentions, windows.mention_changes),
}


def tail_before(daily: DataFrame, first: date | None = None, rows: int = LOOK_BACK) -> DataFrame:
    """The last rows of each category before ``first``, or of all: each map task sends at most ``rows`` a category."""
    before = daily if first is None else daily.where(f"{_DATE} < {day(first)}")
    return top_per_key(before, ["category_name"], [F.col(_DATE).desc()], rows).drop("_position")


def with_tail(name: str, signals: DataFrame, first: date, tail: DataFrame) -> DataFrame:
    """The daily rows from ``first`` on behind the tail. Only partitions from ``first`` on are read of the signals."""
    new = MOMENTUM[name].daily(signals.where(f"{_DATE} >= {day(first)}"))
    return tail.select(new.columns).unionByName(new)


def over_new_days(name: str, behind_tail: DataFrame, first: date) -> DataFrame:
    """The query's rows from ``first`` on."""
    return MOMENTUM[name].windowed(behind_tail).where(f"{_DATE} >= {day(first)}")
