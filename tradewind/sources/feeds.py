"""Landed raw feeds and their reduction to one signal row per category, keyword or community.

Each feed is read with its declared schema and reduced by hash aggregates with map-side combine (or a
per-group top-k that is pruned before its exchange), so what is shuffled grows with the number of
groups and map tasks, never with the number of raw items.
"""

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import catalog, schemas
from tradewind.functions.literals import day, text, text_array, text_map
from tradewind.functions.numeric import ratio
from tradewind.functions.text import strip, title_case
from tradewind.operators.keyed import top_per_key
from tradewind.operators.ranking import with_position
from tradewind.sources.arrival import ARRIVAL

# --- fixed values: how far back a day's run looks ---
POST_DAYS = 7
INTEREST_MONTHS = 3


def lookup(mapping: dict[str, str], key: str) -> str:
    """A fixed 1:1 map as a literal: no join, NULL where the key is absent."""
    return f"try_element_at({text_map(mapping)}, {key})"


def read_json_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def src_listings(pages: DataFrame, as_of: date) -> DataFrame:
    """Listing pages (one or many per category) to one marketplace row per category."""
    items = pages.selectExpr("category_name", "category_id", "total", "explode_outer(itemSummaries) AS item").selectExpr(
        "category_name",
        "category_id",
        "total",
        "item",
        "try_cast(item.price.value AS decimal(18,4)) AS price",
        "array_contains(item.buyingOptions, 'FIXED_PRICE') AS fixed_price",
    )
    reduced = items.groupBy("category_name", "category_id").agg(
        F.expr("max(total) AS total"),
        F.expr("count(item) AS items"),
        F.expr("sum(price) AS price_sum"),
        F.expr("count(price) AS prices"),
        F.expr("count_if(fixed_price) AS sold_count"),
    )
    return reduced.selectExpr(
        "category_name",
        "category_id",
        f"{text(catalog.MARKETPLACE)} AS source",
        f"{day(as_of)} AS snapshot_date",
        "coalesce(total, items) AS listing_count",
        f"{ratio('price_sum', 'prices', 2)} AS avg_price",
        "sold_count",
        f"{ratio('sold_count', 'items', 4)} AS sell_through",
        "CAST(NULL AS int) AS rank_position",
    )


def _ranked_rows(ranked: DataFrame, as_of: date) -> DataFrame:
    """(list_type, rank_position, price) to the common listing columns."""
    return ranked.withColumn(
        "category_name", title_case(F.expr("replace(replace(list_type, 'bestsellers_', ''), '_', ' ')"))
    ).selectExpr(
        "category_name",
        "list_type AS category_id",
        f"{text(catalog.RANKED_LISTS)} AS source",
        f"{day(as_of)} AS snapshot_date",
        "CAST(NULL AS bigint) AS listing_count",
        "CAST(price AS double) AS avg_price",
        "CAST(NULL AS bigint) AS sold_count",
        "CAST(NULL AS decimal(5,4)) AS sell_through",
        "CAST(rank_position AS int) AS rank_position",
    )


def src_bestsellers(lists: DataFrame, as_of: date, size: int | None = None) -> DataFrame:
    """Ranked lists that arrive as arrays: every entry (or the first ``size``), ranked by place."""
    entries = "bestsellers" if size is None else f"slice(bestsellers, 1, {int(size)})"
    ranked = lists.selectExpr("list_type", f"posexplode({entries}) AS (place, entry)").selectExpr(
        "list_type", "place + 1 AS rank_position", "entry.price.value AS price"
    )
    return _ranked_rows(ranked, as_of)


def src_bestseller_items(items: DataFrame, order: list[Column], as_of: date, size: int | None = None) -> DataFrame:
    """Ranked lists that arrive as one row per item (list_type, price): same result.

    The first ``size`` of each list are cut per map task; whole lists are ranked over ranges of their order, since a
    list may hold a third of all items."""
    ranked = with_position(items, ["list_type"], order) if size is None else top_per_key(items, ["list_type"], order, size)
    return _ranked_rows(ranked.withColumnRenamed("_position", "rank_position"), as_of)


def src_search_interest(
    points: DataFrame, as_of: date, keywords: dict[str, str] | None = None, order: list[str] = ("point_ts",)
) -> DataFrame:
    """Keyword series to the last point per keyword of the months up to ``as_of``; keywords outside the map are not tracked."""
    if keywords is None:
        keywords = {k: category for category, words in catalog.SEARCH_KEYWORDS.items() for k in words}
    by_time = order[0] if len(order) == 1 else f"struct({', '.join(order)})"
    latest = (
        points.where(F.col("keyword").isin(list(keywords)))
        .where(f"CAST(point_ts AS date) BETWEEN add_months({day(as_of)}, -{INTEREST_MONTHS}) AND {day(as_of)}")
        .groupBy("keyword")
        .agg(F.expr(f"max_by(interest, {by_time}) AS interest"))
    )
    return latest.selectExpr(
        "keyword",
        f"{lookup(keywords, 'keyword')} AS category_name",
        f"{day(as_of)} AS snapshot_date",
        "CAST(interest AS int) AS interest_score",
        "'US' AS geo",
    )


def search_grid(spark: SparkSession) -> DataFrame:
    """Every community x category term that is searched; a row is reported even without posts."""
    return (
        spark.range(1)
        .selectExpr(f"explode({text_array(catalog.COMMUNITIES)}) AS subreddit")
        .selectExpr("subreddit", f"explode({text_map(catalog.COMMUNITY_TERMS)}) AS (category_name, keyword)")
    )


def src_social_posts(posts: DataFrame, as_of: date, grid: DataFrame | None = None) -> DataFrame:
    """Every landed post of the week up to ``as_of``, as mentions and mean score per community and term."""
    grid = search_grid(posts.sparkSession) if grid is None else grid
    posted = "date_from_unix_date(CAST(floor(created_utc / 86400) AS int))"
    recent = (
        posts.where(f"{posted} BETWEEN {day(as_of - timedelta(days=POST_DAYS))} AND {day(as_of)}")
        .groupBy("subreddit", "keyword")
        .agg(
            F.expr("count(*) AS mention_count"),
            F.expr(f"{ratio('sum(CAST(score AS decimal(18,4)))', 'count(score)', 2)} AS avg_score"),
        )
    )
    return grid.join(recent, ["subreddit", "keyword"], "left").selectExpr(
        "category_name",
        "keyword",
        "subreddit",
        f"{day(as_of)} AS snapshot_date",
        "coalesce(mention_count, 0L) AS mention_count",
        "CAST(coalesce(avg_score, 0) AS decimal(18,2)) AS avg_score",
    )


def read_spend_csv(spark: SparkSession, path: str) -> DataFrame:
    """The expenditure CSV; a missing file is an empty feed."""
    try:
        return spark.read.schema(schemas.SPEND_FEED).option("header", True).option("enforceSchema", False).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.SPEND_FEED)


def src_spend_csv(rows: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """Expenditure rows to category spend and change on the previous year.

    Unmapped labels pass through. Without a previous-year column the change is 0; with a previous
    value of 0 it is NULL. The rows' order of arrival is handed on where it is known.
    """
    arrival = [ARRIVAL] if ARRIVAL in rows.columns else []
    previous = "prev_year_expenditure" if "prev_year_expenditure" in rows.columns else "avg_annual_expenditure"
    amounts = rows.withColumn("label", strip(F.expr("coalesce(category, '')"))).selectExpr(
        "label",
        "year",
        "CAST(avg_annual_expenditure AS decimal(22,4)) AS spend",
        f"CAST({previous} AS decimal(22,4)) AS previous",
        *arrival,
    )
    return amounts.selectExpr(
        f"coalesce({lookup(catalog.SPEND_LABELS if labels is None else labels, 'label')}, label) AS category_name",
        "label AS bls_category",
        "year",
        "round(spend, 2) AS avg_annual_spend",
        "round(try_divide(CAST(spend - previous AS decimal(22,4)), previous), 4) AS yoy_change",
        *arrival,
    )
