"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import catalog, schemas
from tradewind.functions.literals import day
from tradewind.functions.numeric import clip_score
from tradewind.functions.text import normalize_category
from tradewind.operators.normalize import with_minmax
from tradewind.operators.upsert import upsert
from tradewind.plans import analytics, clean, reads, scoring, summaries, views, windows
from tradewind.plans.daily import DailyFeeds, load_day, run_daily
from tradewind.sources import feeds, landing, quarantine
from tradewind.sources.arrival import ARRIVAL
from tradewind.sources.folders import Folder
from tradewind.sources.store import SERIES, SERIES_TABLES, SignalStore, read_table
from tradewind.sources.together import run_together
from tradewind.testbed.mapping import AS_OF, GIVEN, RawFeeds, SignalTables, own_folder

Query = Callable[[SparkSession, str], DataFrame]

DEEP_DIVE = "Electronics"
EXPLORED = ["Electronics", "Pet Supplies", "Toys & Hobbies"]
ENTRY_RUN = date(2024, 1, 24)
PAST_RUN = date(2024, 1, 26)
# The last day of the first of two loads.
FIRST_LOAD = date(2024, 1, 20)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with an engine that has other decimal types."""
    return df.selectExpr(
        *[f"CAST({f.name} AS double) AS {f.name}" if isinstance(f.dataType, T.DecimalType) else f.name for f in df.schema]
    )


def over_signals(build: Callable[[SignalTables], DataFrame], *reuse: str) -> Query:
    """A query over the mapped tables; ``reuse`` names those it reads more than once."""
    return lambda spark, sf_dir: plain(build(SignalTables(spark, sf_dir, reuse).prepare()))


def over_feeds(build: Callable[[RawFeeds], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(RawFeeds(spark, sf_dir)))


# --- views and reads over the mapped tables ---


def leaderboard(t: SignalTables) -> DataFrame:
    return views.mv_category_leaderboard(t.niche_scores, t.category_trends, AS_OF)


def past_leaderboard(t: SignalTables) -> DataFrame:
    """What the board said on an earlier day, from tables that know more by now."""
    return views.mv_category_leaderboard(t.niche_scores, t.category_trends, PAST_RUN)


def past_niches(t: SignalTables) -> DataFrame:
    return views.mv_niche_finder(
        t.niche_scores, t.category_trends, t.search_signals, t.social_buzz, t.consumer_spend, PAST_RUN
    )


def comparison(t: SignalTables) -> DataFrame:
    return views.mv_channel_comparison(t.retail_vs_ecomm)


def niches(t: SignalTables) -> DataFrame:
    return views.mv_niche_finder(
        t.niche_scores, t.category_trends, t.search_signals, t.social_buzz, t.consumer_spend, AS_OF
    )


def explorer(t: SignalTables) -> DataFrame:
    return views.mv_trends_explorer(t.category_trends, t.search_signals, t.social_buzz)


def rising(t: SignalTables, per_date: bool) -> DataFrame:
    return analytics.cte_rising_categories(
        t.niche_scores, t.category_trends, t.search_signals, t.social_buzz, t.consumer_spend, AS_OF, per_date
    )


def top_entries(t: SignalTables) -> DataFrame:
    return analytics.cte_top_entries(t.niche_scores, t.category_trends, t.retail_vs_ecomm, ENTRY_RUN)


def competition_scores(t: SignalTables) -> DataFrame:
    raw = t.score_inputs.selectExpr("*", f"{scoring.competition('avg_listings')} AS raw_competition")
    scaled = with_minmax(raw, "raw_competition", "competition_score", ["as_of"])
    return scaled.select("as_of", "category_name", "competition_score")


def explored(t: SignalTables, signal: str, days: int) -> DataFrame:
    return reads.get_trends_explorer(explorer(t), EXPLORED, AS_OF, signal, days)


# --- keyed loads: old rows, and a batch that overlaps them and holds each key twice ---


def overlapping_batch(t: SignalTables, table: str, overlap: str, changed: str, amount: int) -> DataFrame:
    rows = getattr(t, table)
    return rows.where(f"{schemas.PARTITION_COLUMN[table]} >= {overlap}").selectExpr(
        *[c for c in rows.columns if c != changed],
        f"posexplode(array({changed}, {changed} + {amount})) AS (sequence, {changed})",
    )


def overlapping_upsert(table: str, cut: str, overlap: str, changed: str, amount: int) -> Query:
    """The keyed merge as a plan."""

    def build(t: SignalTables) -> DataFrame:
        old = getattr(t, table).where(f"{schemas.PARTITION_COLUMN[table]} <= {cut}")
        batch = overlapping_batch(t, table, overlap, changed, amount)
        return upsert(old, batch, schemas.KEYS[table], [F.col("sequence").desc()])

    return over_signals(build, table)


def overlapping_load(table: str, cut: str, overlap: str, changed: str, amount: int, *reuse: str) -> Query:
    """The table's own load, into a store that holds the older rows."""

    def build(t: SignalTables) -> DataFrame:
        store = SignalStore(t.spark, own_folder(t.spark))
        load = getattr(store, f"load_{table}")
        load(getattr(t, table).where(f"{schemas.PARTITION_COLUMN[table]} <= {cut}"))
        load(overlapping_batch(t, table, overlap, changed, amount), [F.col("sequence").desc()])
        return store.read(table)

    return over_signals(build, table, *reuse)


def partial_upsert(t: SignalTables) -> DataFrame:
    """A batch without the price and rank columns: those keep their old value, or stay NULL in new rows."""
    existing = t.category_trends.where("snapshot_date <= DATE'2024-01-20'")
    batch = t.category_trends.where("snapshot_date >= DATE'2024-01-15'").selectExpr(
        "category_name", "source", "snapshot_date", "listing_count", "sold_count + 1 AS sold_count", "sell_through"
    )
    return upsert(existing, batch, schemas.KEYS["category_trends"], None, schemas.DEFAULTS["category_trends"])


# --- the store ---


def load_all(store: SignalStore, sf_dir: str) -> None:
    tables = SignalTables(store.spark, sf_dir, ("score_inputs",))
    run_together(store.spark, {t: partial(store.upsert, t, getattr(tables, t)) for t in schemas.TABLES})


def loaded_store(spark: SparkSession, sf_dir: str) -> SignalStore:
    store = SignalStore(spark, own_folder(spark))
    load_all(store, sf_dir)
    return store


def table_sizes(store: SignalStore) -> DataFrame:
    sizes = [
        store.read(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in schemas.TABLES
    ]
    total = sizes[0]
    for size in sizes[1:]:
        total = total.unionByName(size)
    return total


def loaded_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load everything twice; the second load changes nothing."""
    store = loaded_store(spark, sf_dir)
    load_all(store, sf_dir)
    return table_sizes(store)


def reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded_store(spark, sf_dir)
    before = store.read("category_trends").agg(F.count(F.lit(1)).alias("rows_before")).collect()[0][0]
    store.reset_tables()
    return table_sizes(store).withColumn("trend_rows_before", F.lit(before).cast("bigint"))


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded_store(spark, sf_dir)
    report = store.refresh_views(AS_OF)
    rows = None
    for view, outcome in report.items():
        size = store.read_view(view).agg(F.count(F.lit(1)).alias("row_count"))
        line = size.select(F.lit(view).alias("view_name"), F.lit(outcome).alias("outcome"), "row_count")
        rows = line if rows is None else rows.unionByName(line)
    return rows


def back_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refreshed for an earlier day, for the newest and for the earlier once more: that day's board, in one version."""
    store = loaded_store(spark, sf_dir)
    for as_of in (PAST_RUN, AS_OF, PAST_RUN):
        store.refresh_views(as_of)
    versions = [n for n in Folder(spark, store.view_path("mv_category_leaderboard")).names() if n != "CURRENT"]
    return plain(store.read_view("mv_category_leaderboard").withColumn("versions", F.lit(len(versions))))


def load_up_to(store: SignalStore, t: SignalTables, bound: str) -> set[date]:
    """Load the rows of the daily signals for which the bound on their date holds; the dates that were touched."""
    touched = set()
    for table in SERIES_TABLES:
        touched |= getattr(store, f"load_{table}")(getattr(t, table).where(f"snapshot_date {bound}")).partitions
    return touched


def renewed_series(t: SignalTables) -> DataFrame:
    """The series after a refresh over the first load and one of the later days alone."""
    store = SignalStore(t.spark, own_folder(t.spark))
    load_up_to(store, t, f"<= {day(FIRST_LOAD)}")
    store.refresh_views(AS_OF)
    touched = load_up_to(store, t, f"> {day(FIRST_LOAD)}")
    store.refresh_views(AS_OF, touched)
    return store.read_view(SERIES)


def momentum_by_loads(query: str) -> Query:
    """A stored momentum query after three loads, each followed by a refresh of the days it brought."""

    def build(t: SignalTables) -> DataFrame:
        store = SignalStore(t.spark, own_folder(t.spark))
        for bound in (f"<= {day(FIRST_LOAD)}", f"= {day(FIRST_LOAD + timedelta(days=1))}", f"> {day(FIRST_LOAD)}"):
            store.refresh_momentum(load_up_to(store, t, bound))
        return store.read_momentum(query)

    return over_signals(build, *SERIES_TABLES)


def split_listings(raw: RawFeeds) -> quarantine.Split:
    return quarantine.split("category_trends", raw.damaged_listing_batch())


def rejected_listings(raw: RawFeeds) -> DataFrame:
    parts = split_listings(raw)
    return parts.rejected.groupBy(F.col(quarantine.REASON).alias("reason")).agg(F.count("*").alias("rejected"))


def landed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items read back from lines of JSON, beside the number of lines that were cut short."""
    schema = schemas.table(p_partkey=schemas.LONG, p_name=schemas.TEXT, price=schemas.table(value=schemas.DOUBLE))
    landed = landing.land_json(spark, RawFeeds(spark, sf_dir).item_lines(), schema, "items")
    rows = landed.rows.selectExpr("p_partkey", "p_name", "price.value AS price")
    return rows.withColumn("damaged_lines", F.lit(landed.damaged_count).cast("bigint"))


def daily_feeds(raw: RawFeeds, input_id: str | None = None) -> DailyFeeds:
    return DailyFeeds(
        listings=raw.listing_pages(),
        search=raw.search_points(),
        posts=raw.posts(),
        spend=raw.spend_rows(),
        bestsellers=raw.bestseller_items(),
        bestseller_order=raw.bestseller_order(),
        search_order=("point_ts", "event_id"),
        search_keywords=raw.search_keywords,
        spend_labels=raw.SPEND_LABELS,
        input_id=input_id,
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily job from raw feeds; returns the leaderboard it published."""
    raw, store = RawFeeds(spark, sf_dir), SignalStore(spark, own_folder(spark))
    run_daily(store, daily_feeds(raw), AS_OF)
    return plain(store.read_view("mv_category_leaderboard"))


def resumed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board of a run whose loads were finished by a driver that was lost."""
    raw, store = RawFeeds(spark, sf_dir), SignalStore(spark, own_folder(spark))
    load_day(store, daily_feeds(raw, "landed"), AS_OF)
    run_daily(SignalStore(spark, store.root), daily_feeds(raw, "landed"), AS_OF)
    return plain(store.read_view("mv_category_leaderboard"))


def normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = "concat(' \\t', upper(p_name), '\\'s 3d-', p_type, ' & ', p_brand, ' \\n')"
    part = RawFeeds(spark, sf_dir).table("part")
    return part.select("p_partkey", normalize_category(F.expr(messy)).alias("category_name"))


def clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = RawFeeds(spark, sf_dir).table("events")
    shifted = events.selectExpr("event_id", "CASE WHEN event_id % 10 <> 0 THEN value - 20 END AS shifted")
    return shifted.select("event_id", clip_score("shifted").alias("score"))


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, f"{sf_dir}/orders.parquet", GIVEN["orders"])
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def minmax_listings(t: SignalTables) -> DataFrame:
    scaled = with_minmax(t.category_trends, "listing_count", "listing_scaled", ["source", "snapshot_date"])
    return scaled.select("category_name", "source", "snapshot_date", "listing_count", "listing_scaled")


def sparkline(t: SignalTables) -> DataFrame:
    """The score series as text of hundredths."""
    lines = summaries.score_sparkline(reads.get_score_history(t.niche_scores))
    return lines.selectExpr(
        "category_name", "array_join(transform(scores, s -> CAST(CAST(s * 100 AS bigint) AS string)), ',') AS scores"
    )


def build_queries() -> dict[str, Query]:
    def orders_of(names):
        return [F.col(n) for n in names]

    def listings(raw: RawFeeds) -> DataFrame:
        return raw.listing_batch()

    def by_source(raw: RawFeeds, source: str) -> DataFrame:
        return clean.clean_category_trends(
            listings(raw).where(f"source = '{source}'"), orders_of(raw.LISTING_ORDER)
        )

    def channel_summary(t: SignalTables) -> DataFrame:
        return reads.get_channel_summary(comparison(t))

    # A score query reads its inputs twice. Queries on scores and signals read the stored signal tables, as
    # they do after a daily run; those that also look for the newest run read the scores twice.
    scored = ("score_inputs",)
    stored = ("category_trends", "search_signals", "social_buzz", "consumer_spend")
    combined = (*stored, "niche_scores")

    def scores(build: Callable[[SignalTables], DataFrame]) -> Query:
        return over_signals(build, *scored)

    def of_board(build: Callable[[DataFrame], DataFrame]) -> Query:
        return over_signals(lambda t: build(leaderboard(t)), *combined)

    def of_niches(build: Callable[[DataFrame], DataFrame]) -> Query:
        return over_signals(lambda t: build(niches(t)), *stored)

    def of_summary(build: Callable[[DataFrame], DataFrame]) -> Query:
        return over_signals(lambda t: build(channel_summary(t)))

    return {
        # signal tables
        "category_trends": over_signals(lambda t: t.category_trends),
        "search_signals": over_signals(lambda t: t.search_signals),
        "social_buzz": over_signals(lambda t: t.social_buzz),
        "consumer_spend": over_signals(lambda t: t.consumer_spend),
        "retail_vs_ecomm": over_signals(lambda t: t.retail_vs_ecomm),
        # sources and sinks
        "src_listings": over_feeds(lambda r: feeds.src_listings(r.listing_pages(), AS_OF)),
        "src_bestsellers": over_feeds(
            lambda r: feeds.src_bestseller_items(r.bestseller_items(), r.bestseller_order(), AS_OF)
        ),
        "src_bestsellers_lists": over_feeds(lambda r: feeds.src_bestsellers(r.bestseller_lists(), AS_OF)),
        "latest_list_entries": over_feeds(
            lambda r: feeds.src_bestseller_items(r.bestseller_items(), r.bestseller_order(), AS_OF, size=50)
        ),
        "land_json_feed": landed_items,
        "src_search_interest": over_feeds(
            lambda r: feeds.src_search_interest(r.search_points(), AS_OF, r.search_keywords, ["point_ts", "event_id"])
        ),
        "src_social_posts": over_feeds(lambda r: feeds.src_social_posts(r.posts(), AS_OF)),
        "src_spend_csv": over_feeds(lambda r: feeds.src_spend_csv(r.spend_rows(), r.SPEND_LABELS)),
        "read_table": stored_orders,
        "upsert": overlapping_upsert("category_trends", "DATE'2024-01-20'", "DATE'2024-01-15'", "sold_count", 1),
        "upsert_partial": over_signals(partial_upsert, "category_trends"),
        "load_category_trends": overlapping_load(
            "category_trends", "DATE'2024-01-10'", "DATE'2024-01-09'", "listing_count", 7
        ),
        "load_search_signals": overlapping_load(
            "search_signals", "DATE'2024-01-20'", "DATE'2024-01-15'", "interest_score", 1
        ),
        "load_social_buzz": overlapping_load(
            "social_buzz", "DATE'2024-01-20'", "DATE'2024-01-15'", "mention_count", 3
        ),
        "load_consumer_spend": overlapping_load("consumer_spend", "2022", "2021", "avg_annual_spend", 1),
        "load_retail_vs_ecomm": overlapping_load(
            "retail_vs_ecomm", "DATE'2024-01-19'", "DATE'2024-01-13'", "retail_growth", 1
        ),
        "load_niche_scores": overlapping_load(
            "niche_scores", "DATE'2024-01-26'", "DATE'2024-01-24'", "opportunity_score", 1, "score_inputs"
        ),
        "load_tables_twice": loaded_tables,
        "reset_tables": reset,
        "refresh_views": refreshed,
        "refresh_views_back_fill": back_filled,
        "refresh_views_touched_days": over_signals(renewed_series, *SERIES_TABLES),
        # cleaning
        "normalize_category": normalized_names,
        "clip_score": clipped,
        "clean_category_trends": over_feeds(
            lambda r: clean.clean_category_trends(listings(r), ARRIVAL)
        ),
        "clean_search_signals": over_feeds(lambda r: clean.clean_search_signals(r.search_batch(), ARRIVAL)),
        "clean_social_buzz": over_feeds(lambda r: clean.clean_social_buzz(r.social_batch(), ARRIVAL)),
        "clean_consumer_spend": over_feeds(lambda r: clean.clean_consumer_spend(r.spend_batch(), ARRIVAL)),
        "clean_split_listings": over_feeds(lambda r: clean.clean_category_trends(split_listings(r).clean, ARRIVAL)),
        "rejected_listings": over_feeds(rejected_listings),
        "build_retail_vs_ecomm": over_signals(
            lambda t: clean.build_retail_vs_ecomm(t.consumer_spend, AS_OF), "consumer_spend"
        ),
        "union_sources": over_feeds(
            lambda r: clean.union_sources(by_source(r, catalog.MARKETPLACE), by_source(r, catalog.RANKED_LISTS))
        ),
        # scoring
        "score_inputs": over_signals(lambda t: t.score_inputs),
        "minmax_normalize": over_signals(minmax_listings, "category_trends"),
        "competition": scores(competition_scores),
        "opportunity_score": scores(
            lambda t: scoring.component_scores(t.score_inputs).select(
                "as_of", "category_name", scoring.opportunity_score().alias("opportunity_score")
            )
        ),
        "channel_edge": scores(
            lambda t: scoring.component_scores(t.score_inputs).select(
                "as_of", "category_name", "demand_score", scoring.channel_edge("demand_score").alias("channel_edge")
            )
        ),
        "recommendation": scores(
            lambda t: t.niche_scores.select(
                "category_name", "scored_at", scoring.recommendation("opportunity_score").alias("recommendation")
            )
        ),
        "niche_scores": scores(lambda t: t.niche_scores),
        "daily_job": daily,
        "daily_job_resumed": resumed_daily,
        # read models
        "mv_category_leaderboard": of_board(lambda rows: rows),
        "mv_channel_comparison": over_signals(comparison),
        "mv_niche_finder": of_niches(lambda rows: rows),
        "mv_trends_explorer": over_signals(explorer),
        "mv_category_leaderboard_past": over_signals(past_leaderboard, *combined),
        "mv_niche_finder_past": over_signals(past_niches, *stored),
        # window queries
        "wf_sell_through_delta": over_signals(lambda t: windows.wf_sell_through_delta(t.category_trends)),
        "wf_moving_avg": over_signals(lambda t: windows.wf_moving_avg(t.category_trends)),
        "wf_interest_momentum": over_signals(lambda t: windows.wf_interest_momentum(t.search_signals)),
        "wf_buzz_momentum": over_signals(lambda t: windows.wf_buzz_momentum(t.social_buzz)),
        "wf_rank_change": over_signals(lambda t: windows.wf_rank_change(t.niche_scores), "score_inputs", "niche_scores"),
        "wf_percentile": over_signals(lambda t: windows.wf_percentile(t.category_trends, AS_OF), "category_trends"),
        "wf_sell_through_delta_by_loads": momentum_by_loads("wf_sell_through_delta"),
        "wf_moving_avg_by_loads": momentum_by_loads("wf_moving_avg"),
        "wf_interest_momentum_by_loads": momentum_by_loads("wf_interest_momentum"),
        "wf_buzz_momentum_by_loads": momentum_by_loads("wf_buzz_momentum"),
        # analytical queries
        "cte_score_breakdown": over_signals(
            lambda t: analytics.cte_score_breakdown(
                t.niche_scores,
                t.category_trends,
                t.search_signals,
                t.social_buzz,
                t.consumer_spend,
                t.retail_vs_ecomm,
                AS_OF,
            ),
            *combined,
        ),
        "cte_rising_categories": over_signals(lambda t: rising(t, per_date=False), *combined),
        "cte_rising_categories_per_date": over_signals(lambda t: rising(t, per_date=True), *combined),
        "cte_channel_gap": over_signals(lambda t: analytics.cte_channel_gap(t.retail_vs_ecomm)),
        "cte_deep_dive": over_signals(
            lambda t: analytics.cte_deep_dive(
                t.niche_scores, t.category_trends, t.search_signals, t.social_buzz, DEEP_DIVE
            ),
            *stored,
        ),
        "cte_top_entries": over_signals(top_entries, *combined, "retail_vs_ecomm"),
        # read API
        "get_leaderboard": of_board(reads.get_leaderboard),
        "get_score_history": scores(lambda t: reads.get_score_history(t.niche_scores)),
        "get_rising_declining": of_board(reads.get_rising_declining),
        "get_channel_comparison": over_signals(lambda t: reads.get_channel_comparison(comparison(t))),
        "get_channel_summary": of_summary(lambda rows: rows),
        "get_niche_finder": of_niches(
            lambda rows: reads.get_niche_finder(rows, min_score=30, recommendation="watch", max_price=150)
        ),
        "get_category_timeseries": over_signals(lambda t: reads.get_category_timeseries(explorer(t), DEEP_DIVE)),
        "get_category_score_breakdown": of_niches(lambda rows: reads.get_category_score_breakdown(rows, DEEP_DIVE)),
        "get_trends_explorer": over_signals(lambda t: explored(t, "search_interest", 14)),
        "get_all_category_names": of_niches(reads.get_all_category_names),
        # dashboard figures
        "momentum_counts": of_board(summaries.momentum_counts),
        "market_gauge": of_board(summaries.market_gauge),
        "avg_component_scores": of_board(summaries.avg_component_scores),
        "channel_status_counts": of_summary(summaries.channel_status_counts),
        "channels_by_share": of_summary(summaries.channels_by_share),
        "channels_by_growth": of_summary(summaries.channels_by_growth),
        "niche_kpis": of_niches(lambda rows: summaries.niche_kpis(reads.get_niche_finder(rows, min_score=30))),
        "latest_values": over_signals(lambda t: summaries.latest_values(explored(t, "avg_price", 90))),
        "score_sparkline": scores(sparkline),
        "score_band": scores(
            lambda t: t.niche_scores.select(
                "category_name", "scored_at", summaries.score_band("opportunity_score").alias("band")
            )
        ),
    }
