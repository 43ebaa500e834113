"""The four read models. Each is a plain DataFrame; ``sources.store`` writes them."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind import catalog
from tradewind.functions.literals import text
from tradewind.functions.numeric import mean, percent
from tradewind.operators.asof import trailing, until
from tradewind.operators.keyed import latest_per_key
from tradewind.operators.ranking import with_rank

SCORE_COLUMNS = [
    "opportunity_score",
    "trend_score",
    "buzz_score",
    "demand_score",
    "spend_score",
    "competition_score",
    "channel_edge",
    "recommendation",
    "scored_at",
]


LISTING_COLUMNS = ["sell_through", "avg_price", "listing_count"]

SERIES_COLUMNS = [
    "category_name",
    "snapshot_date",
    "sell_through_pct",
    "avg_price",
    "listing_count",
    "sold_count",
    "search_interest",
    "reddit_mentions",
    "source",
]


def momentum(delta: str) -> str:
    return f"CASE WHEN {delta} > 5 THEN 'Rising' WHEN {delta} < -5 THEN 'Declining' ELSE 'Stable' END"


def mv_category_leaderboard(scores: DataFrame, trends: DataFrame, as_of: date | None = None) -> DataFrame:
    """Latest score per category with rank, change on the previous run and newest listing figures.

    "Previous" is the newest score before the newest run of all categories, so a category that run
    left out compares with itself. Latest and previous come from one aggregate per category. On one
    date the marketplace listing beats the ranked lists. Nothing after ``as_of`` counts. Ranks come from
    the scores alone, before the listing figures are joined.
    """
    scores, trends = until(scores, "scored_at", as_of), until(trends, "snapshot_date", as_of)
    earlier = F.when(F.col("scored_at") < scores.agg(F.max("scored_at")).scalar(), F.col("scored_at"))
    current = (
        scores.groupBy("category_name")
        .agg(
            F.expr(f"max_by(struct({', '.join(SCORE_COLUMNS)}), scored_at) AS newest"),
            F.max_by("opportunity_score", earlier).alias("previous"),
        )
        .select("category_name", "newest.*", "previous")
    )
    listing = latest_per_key(trends, "category_name", LISTING_COLUMNS, "snapshot_date", "source")
    delta = "opportunity_score - coalesce(previous, opportunity_score)"
    return (
        with_rank(current, "opportunity_score", "current_rank")
        .join(listing, "category_name", "left")
        .orderBy(F.col("opportunity_score").desc_nulls_first(), "category_name")
        .selectExpr(
            "category_name",
            *SCORE_COLUMNS,
            f"round({delta}, 2) AS score_delta",
            "current_rank",
            *LISTING_COLUMNS,
            f"{momentum(delta)} AS momentum",
        )
    )


def channel_status(share: str, dominant: object, weak: object) -> str:
    return (
        f"CASE WHEN {share} > {dominant} THEN 'E-comm dominant' WHEN {share} < {weak} THEN 'Retail dominant' "
        "ELSE 'Contested' END"
    )


def channel_opportunity(growth: str, share: str, fast: object, small: object) -> str:
    return (
        f"CASE WHEN {growth} > {fast} AND {share} < {small} THEN 'Early mover opportunity' "
        f"WHEN {growth} > {fast} AND {share} >= {small} THEN 'Growing — competitive' "
        f"WHEN {growth} < 0 THEN 'E-comm contracting' ELSE 'Stable' END"
    )


def mv_channel_comparison(channels: DataFrame) -> DataFrame:
    """Shares and growth in percent, with a status per row; unknown figures fall to the last label."""
    return channels.orderBy(
        F.col("period_date").desc_nulls_first(), F.col("ecomm_growth").desc_nulls_first(), "category_name"
    ).selectExpr(
        "category_name",
        "period_date",
        f"{percent('ecomm_share', 1)} AS ecomm_share_pct",
        f"{percent('retail_share', 1)} AS retail_share_pct",
        f"{percent('ecomm_growth', 2)} AS ecomm_growth_pct",
        f"{percent('retail_growth', 2)} AS retail_growth_pct",
        f"{channel_status('ecomm_share', 0.55, 0.30)} AS channel_status",
        f"{channel_opportunity('ecomm_growth', 'ecomm_share', 0.05, 0.45)} AS opportunity_label",
    )


def mv_niche_finder(
    scores: DataFrame, trends: DataFrame, search: DataFrame, social: DataFrame, spend: DataFrame, as_of: date
) -> DataFrame:
    """All signals of a category in one row, none after ``as_of``; what is missing stays NULL.

    Every side is grouped by category, so the joins need no exchange beyond those of the aggregates.
    """
    latest = latest_per_key(until(scores, "scored_at", as_of), "category_name", SCORE_COLUMNS, "scored_at")
    demand = latest_per_key(
        until(trends, "snapshot_date", as_of).where(f"source = {text(catalog.MARKETPLACE)}"),
        "category_name",
        LISTING_COLUMNS,
        "snapshot_date",
    )
    interest = (
        search.where("geo = 'US'")
        .where(trailing("snapshot_date", as_of, 30))
        .groupBy("category_name")
        .agg(F.expr(f"{mean('interest_score', 1)} AS avg_interest_30d"))
    )
    buzz = (
        social.where(trailing("snapshot_date", as_of, 7))
        .groupBy("category_name")
        .agg(
            F.expr("sum(mention_count) AS weekly_mentions"),
            F.expr("count(DISTINCT subreddit) AS subreddit_count"),
        )
    )
    expenses = latest_per_key(spend.where(f"year <= {as_of.year}"), "category_name", ["avg_annual_spend", "yoy_change"], "year")
    joined = latest
    for side in (demand, interest, buzz, expenses):
        joined = joined.join(side, "category_name", "left")
    return joined.orderBy(F.col("opportunity_score").desc_nulls_first(), "category_name").selectExpr(
        "category_name",
        *SCORE_COLUMNS,
        "avg_price",
        "listing_count",
        f"{percent('sell_through', 2)} AS sell_through_pct",
        "avg_interest_30d",
        "weekly_mentions",
        "subreddit_count",
        "avg_annual_spend",
        f"{percent('yoy_change', 2)} AS spend_growth_pct",
    )


def mv_trends_explorer(trends: DataFrame, search: DataFrame, social: DataFrame) -> DataFrame:
    """Time series of every signal per category, date and listing source."""
    on = ["category_name", "snapshot_date"]
    interest = search.where("geo = 'US'").groupBy(*on).agg(F.expr(f"{mean('interest_score', 1)} AS interest"))
    mentions = social.groupBy(*on).agg(F.expr("sum(mention_count) AS mentions"))
    return (
        trends.join(interest, on, "left")
        .join(mentions, on, "left")
        .orderBy("category_name", F.col("snapshot_date").desc_nulls_first(), "source")
        .selectExpr(
            *on,
            f"{percent('sell_through', 2)} AS sell_through_pct",
            "avg_price",
            "listing_count",
            "sold_count",
            "coalesce(interest, 0) AS search_interest",
            "coalesce(mentions, 0) AS reddit_mentions",
            "source",
        )
    )
