"""Analytical queries that combine several signal tables."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind import catalog
from tradewind.functions.literals import day, text
from tradewind.functions.numeric import mean, mean_percent, percent, quotient
from tradewind.operators.asof import newest, trailing, until
from tradewind.operators.keyed import latest_per_key
from tradewind.plans.views import channel_opportunity, channel_status
from tradewind.plans.windows import daily_mentions, lag


def newest_run(scores: DataFrame, as_of: date | None = None) -> DataFrame:
    """The scores of the newest run at or before ``as_of``."""
    return newest(scores, "scored_at", as_of)


def cte_score_breakdown(
    scores: DataFrame,
    trends: DataFrame,
    search: DataFrame,
    social: DataFrame,
    spend: DataFrame,
    channels: DataFrame,
    as_of: date,
) -> DataFrame:
    """Every signal of each category listed in the last week, next to its newest score."""
    def by_category(rows: DataFrame, *figures: str) -> DataFrame:
        return rows.groupBy("category_name").agg(*[F.expr(f) for f in figures])

    interest = by_category(
        search.where("geo = 'US'").where(trailing("snapshot_date", as_of, 30)),
        f"{mean('interest_score', 2)} AS trend_interest",
    )
    buzz = by_category(
        social.where(trailing("snapshot_date", as_of, 7)),
        "sum(mention_count) AS buzz_mentions",
        "count(DISTINCT subreddit) AS subreddit_spread",
    )
    demand = by_category(
        trends.where(trailing("snapshot_date", as_of, 7)),
        f"{mean_percent('sell_through', 2)} AS sell_through_pct",
        f"{mean('avg_price', 2)} AS avg_price",
        "sum(listing_count) AS total_listings",
    )
    expenses = by_category(
        spend.where(f"year BETWEEN {as_of.year - 3} AND {as_of.year}"),
        f"{mean_percent('yoy_change', 2)} AS spend_growth_pct",
        "max(avg_annual_spend) AS annual_spend_usd",
    )
    channel = by_category(
        channels.where(trailing("period_date", as_of, 30)),
        f"{mean_percent('ecomm_share', 2)} AS ecomm_share_pct",
        f"{mean_percent('ecomm_growth', 2)} AS ecomm_growth_pct",
    )
    signals = [
        "trend_interest",
        "buzz_mentions",
        "subreddit_spread",
        "sell_through_pct",
        "avg_price",
        "total_listings",
        "spend_growth_pct",
        "annual_spend_usd",
        "ecomm_share_pct",
        "ecomm_growth_pct",
    ]
    result = demand
    for side in (interest, buzz, expenses, channel, newest_run(scores, as_of)):
        result = result.join(side, "category_name", "left")
    return result.selectExpr(
        "category_name",
        *[f"coalesce({s}, 0) AS {s}" for s in signals],
        "opportunity_score",
        "trend_score",
        "buzz_score",
        "demand_score",
        "spend_score",
        "competition_score",
        "channel_edge",
        "recommendation",
    ).orderBy(F.col("opportunity_score").desc_nulls_last(), "category_name")


def cte_rising_categories(
    scores: DataFrame,
    trends: DataFrame,
    search: DataFrame,
    social: DataFrame,
    spend: DataFrame,
    as_of: date,
    per_date: bool = False,
) -> DataFrame:
    """How many of four signals are up per category of the newest run.

    ``per_date=False`` judges the newest daily change: one row per category (and per listing source
    on the as-of date, of which the marketplace row counts). ``per_date=True`` keeps the multiplicity
    of the plain join: one row per interest date, mention date and listing source of the last 14 days.
    """
    daily_interest = (
        search.where(trailing("snapshot_date", as_of, 14))
        .groupBy("category_name", "snapshot_date")
        .agg(F.expr(f"{quotient('sum(interest_score)', 'count(interest_score)')} AS interest"))
    )
    interest = daily_interest.selectExpr(
        "category_name", "snapshot_date", f"interest - {lag('interest')} AS interest_delta"
    )
    mentions = daily_mentions(social.where(trailing("snapshot_date", as_of, 14))).selectExpr(
        "category_name", "snapshot_date", f"total_mentions - {lag('total_mentions')} AS mention_delta"
    )
    demand = trends.where(f"snapshot_date = {day(as_of)}")
    growth = spend.where(f"year = {as_of.year - 1}")
    if not per_date:
        interest = latest_per_key(interest, "category_name", ["interest_delta"], "snapshot_date")
        mentions = latest_per_key(mentions, "category_name", ["mention_delta"], "snapshot_date")
        demand = latest_per_key(demand, "category_name", ["sell_through"], "snapshot_date", "source")

    joined = newest_run(scores, as_of).select("category_name", "opportunity_score", "recommendation")
    for side, column in (
        (interest, "interest_delta"),
        (mentions, "mention_delta"),
        (demand, "sell_through"),
        (growth, "yoy_change"),
    ):
        joined = joined.join(side.select("category_name", column), "category_name", "left")
    positive = " + ".join(
        f"int(coalesce({condition}, false))"
        for condition in ("interest_delta > 0", "mention_delta > 0", "sell_through > 0.15", "yoy_change > 0")
    )
    return (
        joined.selectExpr("category_name", "opportunity_score", "recommendation", f"{positive} AS signals_positive")
        .selectExpr(
            "*",
            "CASE WHEN signals_positive >= 3 THEN 'Rising' WHEN signals_positive <= 1 THEN 'Declining' "
            "ELSE 'Mixed' END AS momentum_label",
        )
        .orderBy(
            F.col("signals_positive").desc(), F.col("opportunity_score").desc_nulls_first(), "category_name"
        )
    )


def cte_channel_gap(channels: DataFrame) -> DataFrame:
    """Mean shares and growth over all periods; the labels judge the rounded percentages."""
    summary = channels.groupBy("category_name").agg(
        F.expr(f"{mean_percent('ecomm_share', 1)} AS avg_ecomm_share_pct"),
        F.expr(f"{mean_percent('retail_share', 1)} AS avg_retail_share_pct"),
        F.expr(f"{mean_percent('ecomm_growth', 2)} AS avg_ecomm_growth_pct"),
        F.expr(f"{percent('max(ecomm_share) - min(ecomm_share)', 2)} AS share_gain_pct"),
    )
    share, growth = "avg_ecomm_share_pct", "avg_ecomm_growth_pct"
    return summary.selectExpr(
        "*",
        f"{channel_status(share, 55, 30)} AS channel_status",
        f"{channel_opportunity(growth, share, 5, 45)} AS opportunity_label",
    ).orderBy(F.col(growth).desc_nulls_first(), "category_name")


def cte_deep_dive(
    scores: DataFrame,
    trends: DataFrame,
    search: DataFrame,
    social: DataFrame,
    category: str,
    points: int = 12,
    as_of: date | None = None,
) -> DataFrame:
    """The newest points of each signal of one category, beside its newest score.

    A category that was never scored gives no rows. Each branch is a top-k, so at most ``points`` rows
    of it leave a task. With ``as_of`` nothing after that day counts.
    """

    def of_category(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
        return until(df, column, as_of).where(f"category_name = {text(category)}")

    def last_points(df: DataFrame, *ties) -> DataFrame:
        return df.orderBy(F.col("snapshot_date").desc_nulls_first(), *ties).limit(points)

    def branch(df: DataFrame, kind: str, value: str, secondary: str) -> DataFrame:
        return df.selectExpr(
            "category_name",
            f"'{kind}' AS signal_type",
            "snapshot_date AS period",
            f"CAST({value} AS decimal(20,2)) AS value",
            f"CAST({secondary} AS decimal(20,2)) AS secondary_value",
        )

    on = ["category_name", "snapshot_date"]
    demand = last_points(of_category(trends), F.col("source").desc_nulls_last())
    interest = last_points(
        of_category(search).where("geo = 'US'").groupBy(*on).agg(F.expr(f"{mean('interest_score', 1)} AS interest"))
    )
    buzz = last_points(
        of_category(social)
        .groupBy(*on)
        .agg(F.expr("sum(mention_count) AS mentions"), F.expr(f"{mean('avg_score', 1)} AS post_score"))
    )
    signals = (
        branch(demand, "demand", percent("sell_through", 2), "avg_price")
        .unionByName(branch(interest, "interest", "interest", "NULL"))
        .unionByName(branch(buzz, "buzz", "mentions", "post_score"))
    )
    score = latest_per_key(
        of_category(scores, "scored_at"), "category_name", ["opportunity_score", "recommendation"], "scored_at"
    )
    return (
        signals.join(score, "category_name")
        .drop("category_name")
        .orderBy("signal_type", F.col("period").desc_nulls_first())
    )


def cte_top_entries(scores: DataFrame, trends: DataFrame, channels: DataFrame, as_of: date) -> DataFrame:
    """Categories worth entering on ``as_of``, at a price a small seller can stock."""
    entries = newest_run(scores, as_of).where("recommendation = 'enter' AND opportunity_score >= 60")
    listing = trends.where(f"snapshot_date = {day(as_of)} AND source = {text(catalog.MARKETPLACE)}").select(
        "category_name", "avg_price", "sell_through"
    )
    channel = newest(channels, "period_date", as_of).select("category_name", "ecomm_share", "ecomm_growth")
    return (
        entries.join(listing, "category_name", "left")
        .join(channel, "category_name", "left")
        .where("avg_price BETWEEN 15 AND 200")
        .select(
            "category_name",
            "opportunity_score",
            "demand_score",
            "trend_score",
            "buzz_score",
            "competition_score",
            "channel_edge",
            "avg_price",
            "sell_through",
            "ecomm_share",
            "ecomm_growth",
        )
        .orderBy(F.col("opportunity_score").desc_nulls_first(), "category_name")
    )
