"""Figures a dashboard shows on top of the read API."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind import catalog
from tradewind.functions.numeric import mean


def _figures(df: DataFrame, *figures: str) -> DataFrame:
    return df.agg(*[F.expr(f) for f in figures])


def momentum_counts(leaderboard: DataFrame) -> DataFrame:
    return leaderboard.groupBy("momentum").agg(F.expr("count(*) AS categories"))


def market_gauge(leaderboard: DataFrame) -> DataFrame:
    """Market-wide mean score, its change, and the leading category (first by name among equals)."""
    return _figures(
        leaderboard,
        "count(*) AS categories",
        f"{mean('opportunity_score', 4)} AS avg_score",
        f"{mean('score_delta', 4)} AS avg_delta",
        "min_by(category_name, struct(-opportunity_score, category_name)) AS top_category",
        "max(opportunity_score) AS top_score",
        "count_if(momentum = 'Rising') AS rising",
        "count_if(momentum = 'Declining') AS declining",
    ).selectExpr("*", "avg_score - avg_delta AS reference_score")


def avg_component_scores(leaderboard: DataFrame) -> DataFrame:
    components = list(catalog.SCORE_WEIGHTS)
    means = _figures(leaderboard, *[f"{mean(c, 4)} AS {c}" for c in components])
    return means.unpivot([], components, "component", "avg_score")


def channel_status_counts(summary: DataFrame) -> DataFrame:
    return _figures(
        summary,
        "count_if(channel_status = 'E-comm dominant') AS ecomm_dominant",
        "count_if(channel_status = 'Retail dominant') AS retail_dominant",
        "count_if(channel_status = 'Contested') AS contested",
        "count_if(opportunity_label = 'Early mover opportunity') AS early_movers",
    )


def channels_by_share(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.col("avg_ecomm_share").asc_nulls_last(), "category_name")


def channels_by_growth(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.col("avg_ecomm_growth").desc_nulls_last(), "category_name")


def niche_kpis(found: DataFrame) -> DataFrame:
    return _figures(
        found,
        "count(*) AS matched",
        f"{mean('opportunity_score', 4)} AS avg_score",
        "count_if(recommendation = 'enter') AS enter",
    )


def latest_values(series: DataFrame, shown: int | None = None) -> DataFrame:
    """Last known value per category (or the ``shown`` highest), highest first; on one date the higher value counts."""
    latest = (
        series.where("value IS NOT NULL")
        .groupBy("category_name")
        .agg(F.expr("max_by(value, struct(snapshot_date, value)) AS value"))
        .orderBy(F.col("value").desc(), "category_name")
    )
    return latest if shown is None else latest.limit(shown)


def score_sparkline(history: DataFrame) -> DataFrame:
    """Scores in run order per category, for categories with at least two runs."""
    return (
        history.groupBy("category_name")
        .agg(F.expr("sort_array(collect_list(struct(scored_at, opportunity_score))) AS points"))
        .where("size(points) >= 2")
        .selectExpr("category_name", "points.opportunity_score AS scores")
    )


def score_band(score: str) -> Column:
    return F.expr(f"CASE WHEN {score} >= 65 THEN 'positive' WHEN {score} >= 40 THEN 'warning' ELSE 'negative' END")
