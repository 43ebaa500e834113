"""Momentum queries over the signal tables.

Every window is partitioned by category and ordered by date over rows that are already one per
category and date, so a window group is as long as the history in days, not as the raw data.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind import catalog
from tradewind.functions.literals import day, text
from tradewind.functions.numeric import percent, quotient, ratio
from tradewind.operators.ranking import with_rank, with_rows_ahead

_HISTORY = "PARTITION BY category_name ORDER BY snapshot_date"


def lag(value: str, history: str = _HISTORY) -> str:
    return f"lag({value}) OVER ({history})"


def _newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy("category_name", F.col("snapshot_date").desc_nulls_first())


def _marketplace(trends: DataFrame) -> DataFrame:
    return trends.where(f"source = {text(catalog.MARKETPLACE)}")


def listing_days(trends: DataFrame) -> DataFrame:
    """The marketplace's row of each category and day."""
    return _marketplace(trends).select("category_name", "snapshot_date", "listing_count", "sold_count", "sell_through")


def wf_sell_through_delta(trends: DataFrame) -> DataFrame:
    return sell_through_deltas(listing_days(trends))


def sell_through_deltas(days: DataFrame) -> DataFrame:
    before = days.selectExpr(
        "*", f"{lag('sell_through')} AS prev_sell_through", f"{lag('listing_count')} AS prev_listing_count"
    )
    return _newest_first(
        before.selectExpr(
            "category_name",
            "snapshot_date",
            "listing_count",
            "sold_count",
            "sell_through",
            "prev_sell_through",
            f"{percent('sell_through - prev_sell_through', 2)} AS sell_through_delta",
            "prev_listing_count",
            "listing_count - prev_listing_count AS listing_delta",
        )
    )


def wf_moving_avg(trends: DataFrame) -> DataFrame:
    return moving_averages(listing_days(trends))


def moving_averages(days: DataFrame) -> DataFrame:
    def moving(preceding: int) -> str:
        frame = f"({_HISTORY} ROWS BETWEEN {preceding} PRECEDING AND CURRENT ROW)"
        return ratio(f"sum(sell_through) OVER {frame}", f"count(sell_through) OVER {frame}", 4)

    return _newest_first(
        days.selectExpr(
            "category_name",
            "snapshot_date",
            "sell_through",
            f"{moving(3)} AS moving_avg_4w",
            f"{moving(7)} AS moving_avg_8w",
        )
    )


def _steady(value: str, digits: int) -> str:
    """Round after dropping the last digits of inexact quotients, so that exact ties round as ties."""
    return f"round(round({value}, 12), {digits})"


def interest_days(search: DataFrame) -> DataFrame:
    return (
        search.where("geo = 'US'")
        .groupBy("category_name", "snapshot_date")
        .agg(F.expr(f"{quotient('sum(interest_score)', 'count(interest_score)')} AS avg_interest"))
    )


def wf_interest_momentum(search: DataFrame) -> DataFrame:
    return interest_changes(interest_days(search))


def interest_changes(daily: DataFrame) -> DataFrame:
    frame = f"({_HISTORY} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    moving = f"sum(avg_interest) OVER {frame} / nullif(count(avg_interest) OVER {frame}, 0)"
    return _newest_first(
        daily.selectExpr(
            "category_name",
            "snapshot_date",
            "avg_interest",
            f"{_steady('avg_interest - ' + lag('avg_interest'), 2)} AS interest_delta",
            f"{_steady(moving, 2)} AS moving_avg_interest",
        )
    )


def daily_mentions(social: DataFrame) -> DataFrame:
    return social.groupBy("category_name", "snapshot_date").agg(F.expr("sum(mention_count) AS total_mentions"))


def wf_buzz_momentum(social: DataFrame) -> DataFrame:
    return mention_changes(daily_mentions(social))


def mention_changes(daily: DataFrame) -> DataFrame:
    growth = ratio("(total_mentions - prev_mentions) * 100", "prev_mentions", 2)
    return _newest_first(
        daily.selectExpr("*", f"{lag('total_mentions')} AS prev_mentions")
        .selectExpr(
            "*",
            "total_mentions - prev_mentions AS mention_delta",
            f"CASE WHEN prev_mentions > 0 THEN {growth} END AS mention_growth_pct",
        )
    )


def wf_rank_change(scores: DataFrame) -> DataFrame:
    """Rank per run and its change on the category's previous run (positive = fell)."""
    ranked = with_rank(
        scores.select("category_name", "scored_at", "opportunity_score"),
        "opportunity_score",
        "rank_this_week",
        ["scored_at"],
    )
    before = lag("rank_this_week", "PARTITION BY category_name ORDER BY scored_at")
    return (
        ranked.selectExpr("*", f"{before} AS rank_last_week")
        .selectExpr("*", "rank_this_week - rank_last_week AS rank_change")
        .orderBy(F.col("scored_at").desc_nulls_first(), "rank_this_week", "category_name")
    )


def wf_percentile(trends: DataFrame, as_of: date) -> DataFrame:
    """Percent rank and quartile of each row by sell-through on one date.

    Both follow from the rows ahead of a value. Rows with an equal value are numbered by category and
    source, which settles where a quartile ends inside them.
    """
    rows = trends.where(f"snapshot_date = {day(as_of)}").select(
        "category_name", "source", "snapshot_date", "sell_through"
    )
    placed = with_rows_ahead(rows, "sell_through", ["snapshot_date"], descending=False).selectExpr(
        "*",
        "_ahead + row_number() OVER (PARTITION BY snapshot_date, sell_through ORDER BY category_name, source) AS place",
        # The first (total % 4) quartiles hold one row more than the others.
        "_total div 4 AS small",
        "_total % 4 AS larger",
    )
    in_larger = "larger * (small + 1)"
    quartile = (
        f"CASE WHEN place <= {in_larger} THEN (place - 1) div (small + 1) + 1 "
        f"ELSE larger + (place - {in_larger} - 1) div small + 1 END"
    )
    percentile = ratio("_ahead * 100", "_total - 1", 1)
    return placed.selectExpr(
        "category_name",
        "snapshot_date",
        "sell_through",
        f"CASE WHEN _total = 1 THEN 0 ELSE {percentile} END AS sell_through_percentile",
        f"CAST({quartile} AS int) AS demand_quartile",
    ).orderBy(F.col("sell_through_percentile").desc_nulls_first(), "category_name")
