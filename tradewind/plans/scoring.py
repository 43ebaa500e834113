"""Composite opportunity score of every category, for one or many as-of dates in one job."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind import catalog, schemas
from tradewind.functions.literals import day
from tradewind.functions.numeric import mean_double, round_binary, zero_if_missing
from tradewind.operators.asof import as_dates, spread, spread_to_as_of
from tradewind.operators.normalize import scale_to_100

TREND_DAYS = 30
BUZZ_DAYS = 7
SPEND_YEARS = 2

_KEY = ["as_of", "category_name"]


def score_inputs(
    trends: DataFrame, search: DataFrame, social: DataFrame, spend: DataFrame, as_of: date | list[date]
) -> DataFrame:
    """Raw signals per (as_of, category) with a trends row on the as-of date; missing signals are 0.

    The interest mean exists per day and is scaled over all days of the window, of which the newest
    one is scored; ``trend_low`` and ``trend_high`` keep a category's extremes for that scaling, so
    the days need not be carried along. Every side is grouped on the join key, so the joins add no
    exchange of their own.
    """
    dates = as_dates(as_of)

    daily_interest = search.groupBy("category_name", "snapshot_date").agg(
        F.expr(f"coalesce({mean_double('interest_score')}, 0D) AS daily")
    )
    interest = (
        spread_to_as_of(daily_interest, "snapshot_date", dates, TREND_DAYS)
        .groupBy(*_KEY)
        .agg(
            F.expr("max_by(daily, snapshot_date) AS interest"),
            F.expr("min(daily) AS low"),
            F.expr("max(daily) AS high"),
        )
    )
    mentions = (
        spread_to_as_of(social, "snapshot_date", dates, BUZZ_DAYS)
        .groupBy(*_KEY)
        .agg(F.expr("sum(mention_count) AS mentions"))
    )
    demand = (
        trends.where(f"snapshot_date IN ({', '.join(day(d) for d in dates)})")
        .withColumnRenamed("snapshot_date", "as_of")
        .groupBy(*_KEY)
        .agg(
            F.expr(f"{mean_double('sell_through')} AS sell_through"),
            F.expr(f"{mean_double('listing_count')} AS listings"),
        )
    )
    years = spend.where(f"year BETWEEN {dates[0].year - SPEND_YEARS} AND {dates[-1].year}")
    growth = (
        spread(years, dates, f"year BETWEEN year(d) - {SPEND_YEARS} AND year(d)")
        .groupBy(*_KEY)
        .agg(F.expr(f"{mean_double('yoy_change')} AS growth"))
    )
    return (
        demand.join(interest, _KEY, "left")
        .join(mentions, _KEY, "left")
        .join(growth, _KEY, "left")
        .selectExpr(
            *_KEY,
            f"{zero_if_missing('interest')} AS raw_trend",
            f"{zero_if_missing('low')} AS trend_low",
            f"{zero_if_missing('high')} AS trend_high",
            f"{zero_if_missing('mentions')} AS raw_buzz",
            f"{zero_if_missing('sell_through')} * 100D AS raw_demand",
            f"{zero_if_missing('growth')} * 100D AS raw_spend",
            f"{zero_if_missing('listings')} AS avg_listings",
        )
    )


def competition(listings: str) -> str:
    """Falls as listings grow; scaled to 0..100 afterwards."""
    return f"1D / ({listings} + 1D) * 10000D"


def opportunity_score() -> Column:
    """Weighted sum of the rounded component scores, rounded again."""
    total = " + ".join(f"{component} * {weight}D" for component, weight in catalog.SCORE_WEIGHTS.items())
    return F.expr(round_binary(total, 2))


def channel_edge(demand: str) -> Column:
    return F.expr(f"CASE WHEN {demand} > 60 THEN 'ecomm' WHEN {demand} < 35 THEN 'retail' ELSE 'mixed' END")


def recommendation(score: str) -> Column:
    return F.expr(f"CASE WHEN {score} >= 65 THEN 'enter' WHEN {score} >= 40 THEN 'watch' ELSE 'avoid' END")


def component_scores(inputs: DataFrame) -> DataFrame:
    """Scale each raw signal to 0..100 among the categories of one as-of date.

    The bounds are a hash aggregate of one row per as-of date, joined back: no window gathers all
    categories in one task, and the broadcast side has as many rows as dates were asked for. ``inputs``
    is read twice; keep it (persist or write it) when it is costly.
    """
    ranges = {
        "trend": ("raw_trend", "trend_low", "trend_high"),
        "buzz": ("raw_buzz",) * 3,
        "demand": ("raw_demand",) * 3,
        "spend": ("raw_spend",) * 3,
        "competition": (competition("avg_listings"),) * 3,
    }
    bounds = inputs.groupBy("as_of").agg(
        *[F.expr(f"min({low}) AS {name}_min") for name, (_, low, _) in ranges.items()],
        *[F.expr(f"max({high}) AS {name}_max") for name, (_, _, high) in ranges.items()],
    )
    return inputs.join(bounds, "as_of").selectExpr(
        *_KEY,
        *[
            f"{scale_to_100(value, f'{name}_min', f'{name}_max')} AS {name}_score"
            for name, (value, _, _) in ranges.items()
        ],
    )


def score_categories(inputs: DataFrame) -> DataFrame:
    """The ``niche_scores`` rows for prepared inputs."""
    scored = component_scores(inputs).withColumn("opportunity_score", opportunity_score())
    labelled = scored.withColumns(
        {
            "scored_at": F.col("as_of"),
            "channel_edge": channel_edge("demand_score"),
            "recommendation": recommendation("opportunity_score"),
        }
    )
    return schemas.typed(labelled, schemas.NICHE_SCORES)


def niche_scores(
    trends: DataFrame, search: DataFrame, social: DataFrame, spend: DataFrame, as_of: date | list[date]
) -> DataFrame:
    """The ``niche_scores`` rows of every as-of date; a date without trends rows has none."""
    return score_categories(score_inputs(trends, search, social, spend, as_of))
