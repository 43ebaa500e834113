"""The daily job: feeds -> cleaned signals -> keyed load -> scores -> read models."""

from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.plans import clean
from tradewind.plans.scoring import niche_scores
from tradewind.sources import feeds, quarantine
from tradewind.sources.arrival import ARRIVAL
from tradewind.sources.ledger import Ledger
from tradewind.sources.store import SERIES_TABLES, Loaded, SignalStore
from tradewind.sources.together import run_together

_CLEAN = {
    "category_trends": clean.clean_category_trends,
    "search_signals": clean.clean_search_signals,
    "social_buzz": clean.clean_social_buzz,
    "consumer_spend": clean.clean_consumer_spend,
}


@dataclass
class DailyFeeds:
    """Raw feeds of one day. ``bestsellers`` is optional; the orders say how rows arrived. ``input_id`` names what landed:
    with it, finished stages are remembered and not run again."""

    listings: DataFrame
    search: DataFrame
    posts: DataFrame
    spend: DataFrame
    bestsellers: DataFrame | None = None
    bestseller_order: list[Column] | None = None  # given when bestsellers are one row per item
    search_order: tuple[str, ...] = ("point_ts",)
    search_keywords: dict[str, str] | None = None
    spend_labels: dict[str, str] | None = None
    spend_order: tuple[str, ...] = ("bls_category", "yoy_change", "avg_annual_spend")  # unless the rows have an arrival number
    input_id: str | None = None


def _batches(raw: DailyFeeds, as_of: date) -> dict[str, list[tuple[DataFrame, list[Column] | str]]]:
    """The batches of each signal table, in the order of their sources, with what says which of a key's rows is first."""
    listings = [(feeds.src_listings(raw.listings, as_of), [F.col("category_id").asc_nulls_last()])]
    if raw.bestsellers is not None:
        # Of a list only its first entry stays, as all have the list's key.
        if raw.bestseller_order is None:
            entries = feeds.src_bestsellers(raw.bestsellers, as_of, size=1)
        else:
            entries = feeds.src_bestseller_items(raw.bestsellers, raw.bestseller_order, as_of, size=1)
        listings.append((entries, [F.col("rank_position"), F.col("category_id")]))
    interest = feeds.src_search_interest(raw.search, as_of, raw.search_keywords, list(raw.search_order))
    spend = feeds.src_spend_csv(raw.spend, raw.spend_labels)
    spend_first = ARRIVAL if ARRIVAL in spend.columns else [F.col(c).asc_nulls_last() for c in raw.spend_order]
    return {
        "category_trends": listings,
        "search_signals": [(interest, [F.col("keyword")])],
        "social_buzz": [(feeds.src_social_posts(raw.posts, as_of), [F.col("subreddit"), F.col("keyword")])],
        "consumer_spend": [(spend, spend_first)],
    }


def load_day(store: SignalStore, raw: DailyFeeds, as_of: date) -> dict[str, Loaded]:
    """Clean and load one day's feeds: records and touched partitions of each table.

    Rows that cannot be cleaned are kept aside with a reason (``<table>_rejected`` counts them, where there are any)."""
    batches, ledger = _batches(raw, as_of), Ledger(store.spark, store.root)

    def load(table: str) -> dict[str, list]:
        """[records, touched partitions as text] of the table and [rejects] of its batches."""
        cleaned, rejected = None, None
        for batch, first in batches[table]:
            parts = quarantine.split(table, batch)
            part = _CLEAN[table](parts.clean, first)
            cleaned = part if cleaned is None else clean.union_sources(cleaned, part)
            if parts.rejects:
                record = parts.rejected
                rejected = record if rejected is None else rejected.unionByName(record, allowMissingColumns=True)
        if table == "consumer_spend":
            channels = store.load_retail_vs_ecomm(clean.build_retail_vs_ecomm(cleaned, as_of))
        loaded = getattr(store, f"load_{table}")(cleaned)
        report = {table: [int(loaded), sorted(map(str, loaded.partitions))]}
        if table == "consumer_spend":
            report["retail_vs_ecomm"] = [int(channels), sorted(map(str, channels.partitions))]
        if rejected is not None:
            store.reject(table, rejected, as_of)
            report[f"{table}_rejected"] = [store.read_rejects(table).where(F.col("run_date") == as_of).count(), []]
        return report

    stages = {table: partial(ledger.once, as_of, raw.input_id, f"load-{table}", partial(load, table)) for table in batches}
    report = {}
    for done in run_together(store.spark, stages).values():
        report.update({name: Loaded(records, partitions) for name, (records, partitions) in done.items()})
    return report


def _series_dates(report: dict[str, Loaded]) -> set[date]:
    return {date.fromisoformat(day) for table in SERIES_TABLES for day in report[table].partitions}


def score_days(store: SignalStore, as_of: list[date]) -> Loaded:
    """Score one or many dates from the loaded tables in one job."""
    tables = [store.read(t) for t in ("category_trends", "search_signals", "social_buzz", "consumer_spend")]
    return store.load_niche_scores(niche_scores(*tables, as_of))


def run_daily(store: SignalStore, raw: DailyFeeds, as_of: date) -> dict[str, int | str]:
    """Run the job for one date and report records per table and the outcome per view.

    Scoring reads the loaded tables, so it sees history. Running a date again changes nothing. Where the feeds have an
    ``input_id``, a run that was cut short goes on after its last finished stage. Read models are always refreshed, for
    this date; of the series only the dates that the loads touched."""
    report: dict[str, int | str] = dict(load_day(store, raw, as_of))
    ledger = Ledger(store.spark, store.root)
    report["niche_scores"] = ledger.once(as_of, raw.input_id, "scores", lambda: int(score_days(store, [as_of])))
    report.update(store.refresh_views(as_of, _series_dates(report)))
    return report


def run_backfill(store: SignalStore, days: dict[date, DailyFeeds]) -> dict[date, dict[str, int]]:
    """Run many dates: each is loaded once, all are scored in one job, and the read models are refreshed once, for the
    newest. Dates and stages that the ledger holds are not run again. Records per date and table, and under the newest
    date the outcome per view."""
    if not days:
        return {}
    ledger, reports = Ledger(store.spark, store.root), {}
    for as_of in sorted(days):
        reports[as_of] = dict(load_day(store, days[as_of], as_of))
    touched = set().union(*(_series_dates(report) for report in reports.values()))
    open_days = [d for d in sorted(days) if days[d].input_id is None or ledger.finished(d, days[d].input_id, "scores") is None]
    if open_days:
        score_days(store, open_days)
    scored = store.read("niche_scores").where(F.col("scored_at").isin(list(days))).groupBy("scored_at").count()
    counts = dict(scored.collect())
    for as_of, report in reports.items():
        report["niche_scores"] = ledger.once(as_of, days[as_of].input_id, "scores", lambda n=counts.get(as_of, 0): n)
    reports[max(days)].update(store.refresh_views(max(days), touched))
    return reports
