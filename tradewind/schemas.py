"""Explicit schemas, keys and partition columns of the tables, and of the landed feeds.

Counts are BIGINT: at 100 TB of raw items a daily per-category count passes the INTEGER range.
So is a spend amount wider than the reference's 12 digits, since a feed may carry totals of all orders: these pass
10 digits before the point at 1 GB. Parquet holds up to 18 digits as the same integers, so older files read as before.
"""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEXT, DATE, INT, LONG, DOUBLE = T.StringType(), T.DateType(), T.IntegerType(), T.LongType(), T.DoubleType()


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order and in their declared types."""
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema])


CATEGORY_TRENDS = table(
    category_name=TEXT,
    category_id=TEXT,
    source=TEXT,
    snapshot_date=DATE,
    listing_count=LONG,
    avg_price=T.DecimalType(10, 2),
    sold_count=LONG,
    sell_through=T.DecimalType(5, 4),
    rank_position=INT,
)
RETAIL_VS_ECOMM = table(
    category_name=TEXT,
    period_date=DATE,
    ecomm_share=T.DecimalType(5, 4),
    retail_share=T.DecimalType(5, 4),
    ecomm_growth=T.DecimalType(8, 4),
    retail_growth=T.DecimalType(8, 4),
    source=TEXT,
)
SEARCH_SIGNALS = table(keyword=TEXT, category_name=TEXT, snapshot_date=DATE, interest_score=INT, geo=TEXT)
SOCIAL_BUZZ = table(
    category_name=TEXT,
    keyword=TEXT,
    subreddit=TEXT,
    snapshot_date=DATE,
    mention_count=LONG,
    avg_score=T.DecimalType(8, 2),
)
CONSUMER_SPEND = table(
    category_name=TEXT,
    bls_category=TEXT,
    year=INT,
    avg_annual_spend=T.DecimalType(18, 2),
    yoy_change=T.DecimalType(8, 4),
)
NICHE_SCORES = table(
    category_name=TEXT,
    scored_at=DATE,
    trend_score=T.DecimalType(5, 2),
    buzz_score=T.DecimalType(5, 2),
    demand_score=T.DecimalType(5, 2),
    spend_score=T.DecimalType(5, 2),
    competition_score=T.DecimalType(5, 2),
    opportunity_score=T.DecimalType(5, 2),
    channel_edge=TEXT,
    recommendation=TEXT,
)

TABLES = {
    "category_trends": CATEGORY_TRENDS,
    "retail_vs_ecomm": RETAIL_VS_ECOMM,
    "search_signals": SEARCH_SIGNALS,
    "social_buzz": SOCIAL_BUZZ,
    "consumer_spend": CONSUMER_SPEND,
    "niche_scores": NICHE_SCORES,
}

KEYS = {
    "category_trends": ["category_name", "source", "snapshot_date"],
    "retail_vs_ecomm": ["category_name", "period_date", "source"],
    "search_signals": ["keyword", "snapshot_date", "geo"],
    "social_buzz": ["keyword", "subreddit", "snapshot_date"],
    "consumer_spend": ["category_name", "year"],
    "niche_scores": ["category_name", "scored_at"],
}

# Each partition column is part of its table's key, so an upsert only touches the batch's partitions.
PARTITION_COLUMN = {
    "category_trends": "snapshot_date",
    "retail_vs_ecomm": "period_date",
    "search_signals": "snapshot_date",
    "social_buzz": "snapshot_date",
    "consumer_spend": "year",
    "niche_scores": "scored_at",
}

# Landed feeds, as the upstream services shape them.
LISTING_FEED = table(
    category_name=TEXT,
    category_id=TEXT,
    total=LONG,
    itemSummaries=T.ArrayType(table(price=table(value=TEXT), buyingOptions=T.ArrayType(TEXT))),
)
RANKED_FEED = table(list_type=TEXT, bestsellers=T.ArrayType(table(price=table(value=DOUBLE))))
SEARCH_FEED = table(keyword=TEXT, point_ts=T.TimestampNTZType(), interest=DOUBLE)
POST_FEED = table(subreddit=TEXT, keyword=TEXT, result_position=LONG, created_utc=DOUBLE, score=DOUBLE)
SPEND_FEED = table(category=TEXT, year=INT, avg_annual_expenditure=DOUBLE, prev_year_expenditure=DOUBLE)

# Values a new row takes in columns its batch does not supply.
DEFAULTS = {
    "category_trends": {"source": "ebay"},
    "retail_vs_ecomm": {"source": "bls"},
    "search_signals": {"geo": "US"},
    "social_buzz": {"mention_count": 0},
    "consumer_spend": {},
    "niche_scores": {},
}
