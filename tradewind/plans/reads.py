"""Read API over the read models: projections, filters and orders with bound values only."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numeric import mean
from tradewind.operators.asof import trailing

_NICHE_COLUMNS = [
    "category_name",
    "opportunity_score",
    "trend_score",
    "buzz_score",
    "demand_score",
    "spend_score",
    "competition_score",
    "channel_edge",
    "recommendation",
    "avg_price",
    "sell_through_pct",
    "avg_interest_30d",
    "weekly_mentions",
    "spend_growth_pct",
    "listing_count",
]

EXPLORER_SIGNALS = ["sell_through_pct", "avg_price", "listing_count", "search_interest", "reddit_mentions"]


def _best_first(column: str):
    return [F.col(column).desc_nulls_first(), F.col("category_name")]


def get_leaderboard(leaderboard: DataFrame) -> DataFrame:
    return leaderboard.orderBy(*_best_first("opportunity_score")).select(
        "category_name",
        "opportunity_score",
        "trend_score",
        "buzz_score",
        "demand_score",
        "spend_score",
        "competition_score",
        "channel_edge",
        "recommendation",
        "momentum",
        "score_delta",
        "current_rank",
        "avg_price",
        "sell_through",
        "listing_count",
    )


def get_score_history(scores: DataFrame) -> DataFrame:
    return scores.select("category_name", "scored_at", "opportunity_score").orderBy("category_name", "scored_at")


def get_rising_declining(leaderboard: DataFrame) -> DataFrame:
    return leaderboard.orderBy(*_best_first("score_delta")).select(
        "category_name", "opportunity_score", "score_delta", "momentum", "recommendation", "channel_edge"
    )


def get_channel_comparison(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy(F.col("period_date").desc_nulls_first(), *_best_first("ecomm_growth_pct")).select(
        "category_name",
        "period_date",
        "ecomm_share_pct",
        "retail_share_pct",
        "ecomm_growth_pct",
        "retail_growth_pct",
        "channel_status",
        "opportunity_label",
    )


def get_channel_summary(comparison: DataFrame) -> DataFrame:
    """Means of the rounded percentages; of several labels the greatest text."""
    return (
        comparison.groupBy("category_name")
        .agg(
            F.expr(f"{mean('ecomm_share_pct', 1)} AS avg_ecomm_share"),
            F.expr(f"{mean('retail_share_pct', 1)} AS avg_retail_share"),
            F.expr(f"{mean('ecomm_growth_pct', 2)} AS avg_ecomm_growth"),
            F.expr("max(channel_status) AS channel_status"),
            F.expr("max(opportunity_label) AS opportunity_label"),
        )
        .orderBy(*_best_first("avg_ecomm_growth"))
    )


def get_niche_finder(
    niches: DataFrame,
    min_score: float = 0,
    recommendation: str | None = None,
    channel_edge: str | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """Niches that pass every filter given; an unknown price fails the price filter."""
    found = niches.where(F.col("opportunity_score") >= F.lit(min_score))
    if recommendation:
        found = found.where(F.col("recommendation") == F.lit(recommendation))
    if channel_edge:
        found = found.where(F.col("channel_edge") == F.lit(channel_edge))
    if max_price:
        found = found.where(F.col("avg_price") <= F.lit(max_price))
    return found.orderBy(*_best_first("opportunity_score")).select(*_NICHE_COLUMNS)


def get_category_timeseries(explorer: DataFrame, category_name: str) -> DataFrame:
    return (
        explorer.where(F.col("category_name") == F.lit(category_name))
        .orderBy("snapshot_date", "source")
        .select(
            "snapshot_date",
            "sell_through_pct",
            "avg_price",
            "listing_count",
            "sold_count",
            "search_interest",
            "reddit_mentions",
            "source",
        )
    )


def get_category_score_breakdown(niches: DataFrame, category_name: str) -> DataFrame:
    return niches.where(F.col("category_name") == F.lit(category_name)).select(*_NICHE_COLUMNS)


def get_trends_explorer(
    explorer: DataFrame, categories: list[str], as_of: date, signal: str = "sell_through_pct", days: int = 90
) -> DataFrame:
    """One signal of the chosen categories; an unknown signal falls back to sell-through."""
    column = signal if signal in EXPLORER_SIGNALS else "sell_through_pct"
    return (
        explorer.where(F.col("category_name").isin(list(categories)))
        .where(trailing("snapshot_date", as_of, days))
        .orderBy("category_name", "snapshot_date", "source")
        .select("category_name", "snapshot_date", F.col(column).alias("value"))
    )


def get_all_category_names(niches: DataFrame) -> DataFrame:
    return niches.select("category_name").distinct().orderBy("category_name")
