"""Keyed loads, the stored tables, the read models and the daily job."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators.upsert import upsert
from tradewind.plans import analytics, increments, windows
from tradewind.plans.analytics import newest_run
from tradewind.plans.daily import DailyFeeds, load_day, run_backfill, run_daily
from tradewind.sources import shared
from tradewind.sources.folders import Folder
from tradewind.sources.store import SERIES, SignalStore
from tradewind.testbed.mapping import own_folder

AS_OF = date(2024, 6, 30)
KEYS = schemas.KEYS["search_signals"]


def signal(keyword, value, day="2024-06-30", geo="US"):
    return {"keyword": keyword, "category_name": "A", "snapshot_date": day, "interest_score": value, "geo": geo}


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    return SignalStore(spark, str(tmp_path))


def test_upsert_inserts_updates_and_keeps(make):
    old = make("search_signals", [signal("a", 1), signal("b", 2), signal("a", 3, geo="CA")])
    new = make("search_signals", [signal("b", 20), signal("c", 30)])
    merged = upsert(old, new, KEYS)
    assert {(r["keyword"], r["geo"]): r["interest_score"] for r in rows(merged)} == {
        ("a", "US"): 1, ("a", "CA"): 3, ("b", "US"): 20, ("c", "US"): 30,
    }
    assert content(upsert(merged, new, KEYS)) == content(merged)


def test_upsert_last_record_wins(make):
    old = make("search_signals", [signal("a", 1)])
    new = make("search_signals", [signal("a", v) for v in (5, 9, 7)]).withColumn("n", F.expr("CASE interest_score WHEN 5 THEN 0 WHEN 9 THEN 1 ELSE 2 END"))
    assert [r["interest_score"] for r in rows(upsert(old, new, KEYS, [F.col("n").desc()]))] == [7]


def test_upsert_of_some_columns(make):
    old = make("category_trends", [{"category_name": "A", "source": "ebay", "snapshot_date": AS_OF, "avg_price": 5, "sold_count": 1}])
    new = old.select("category_name", "snapshot_date", "source", F.lit(8).alias("sold_count"))
    new = new.unionByName(new.withColumn("category_name", F.lit("B")))
    merged = {r["category_name"]: r for r in rows(upsert(old, new, schemas.KEYS["category_trends"]))}
    assert (merged["A"]["avg_price"], merged["A"]["sold_count"]) == (5, 8)
    assert (merged["B"]["avg_price"], merged["B"]["sold_count"]) == (None, 8)


def test_upsert_defaults_of_new_rows(make):
    old = make("social_buzz", [])
    new = make("social_buzz", [{"category_name": "A", "keyword": "k", "subreddit": "s", "snapshot_date": AS_OF}]).drop("mention_count")
    merged = rows(upsert(old, new, schemas.KEYS["social_buzz"], None, schemas.DEFAULTS["social_buzz"]))
    assert merged[0]["mention_count"] == 0 and merged[0]["avg_score"] is None


def test_unwritten_tables_are_empty(store):
    for table, schema in schemas.TABLES.items():
        empty = store.read(table)
        assert empty.count() == 0 and empty.columns == schema.names


def test_load_is_idempotent_and_touches_only_its_partitions(store, make, tmp_path):
    assert store.load_search_signals(make("search_signals", [signal("a", 1, "2024-06-29"), signal("a", 2)])) == 2
    untouched = tmp_path / "tables/search_signals/snapshot_date=2024-06-29"
    before = sorted(p.name for p in untouched.iterdir())
    batch = make("search_signals", [signal("a", 9), signal("b", 3)])
    assert store.load_search_signals(batch) == 2
    once = content(store.read("search_signals"))
    assert store.load_search_signals(batch) == 2
    assert content(store.read("search_signals")) == once
    assert [r[3] for r in once] == [1, 9, 3]
    assert sorted(p.name for p in untouched.iterdir()) == before
    assert store.load_search_signals(make("search_signals", [])) == 0


def test_every_load_uses_its_key(store, make):
    day = {"snapshot_date": AS_OF, "period_date": AS_OF, "scored_at": AS_OF, "year": 2024}
    filled = {"category_name": "A", "source": "x", "keyword": "k", "geo": "US", "subreddit": "s"}
    for table, schema in schemas.TABLES.items():
        row = {k: v for k, v in {**day, **filled}.items() if k in schema.names}
        load = getattr(store, f"load_{table}")
        assert load(make(table, [row])) == 1 and load(make(table, [row])) == 1
        assert store.read(table).count() == 1, table
        assert store.read(table).schema.simpleString() == schema.simpleString()


def test_types_survive_the_round_trip(store, make):
    store.load_consumer_spend(make("consumer_spend", [{"category_name": "A", "year": 2023, "avg_annual_spend": 1234.57, "yoy_change": -0.0457}]))
    assert rows(store.read("consumer_spend"))[0]["yoy_change"] == Decimal("-0.0457")


def test_reset_empties_all_tables(store, make):
    store.load_search_signals(make("search_signals", [signal("a", 1)]))
    store.reset_tables()
    assert {t: store.read(t).count() for t in schemas.TABLES} == dict.fromkeys(schemas.TABLES, 0)
    assert store.load_search_signals(make("search_signals", [signal("b", 1)])) == 1
    assert store.read("search_signals").count() == 1


def test_one_failing_view_does_not_stop_the_others(store, make, monkeypatch):
    store.load_niche_scores(make("niche_scores", [{"category_name": "A", "scored_at": AS_OF, "opportunity_score": 5}]))
    real = store.view_builders

    def broken(as_of, dates=None):
        def unresolved():
            return store.read("niche_scores").select("no_such_column")

        failing = {"mv_channel_comparison": lambda: store.read("niche_scores").selectExpr("raise_error('broken') AS x"), "mv_niche_finder": unresolved}
        return {**real(as_of, dates), **failing}

    monkeypatch.setattr(store, "view_builders", broken)
    report = store.refresh_views(AS_OF)
    assert report.pop("mv_niche_finder").startswith("failed")
    assert report.pop("mv_channel_comparison").startswith("failed")
    assert set(report.values()) == {"refreshed"} and len(report) == 2
    assert store.read_view("mv_category_leaderboard").count() == 1
    with pytest.raises(ValueError, match="not been published"):
        store.read_view("mv_channel_comparison")


def versions(store, view):
    return [n for n in Folder(store.spark, store.view_path(view)).names() if n.startswith("v-")]


def test_refreshes_leave_one_version_and_failed_ones_the_old(store, make, monkeypatch):
    board = "mv_category_leaderboard"
    for value in (5, 6, 7):
        store.load_niche_scores(make("niche_scores", [{"category_name": "A", "scored_at": AS_OF, "opportunity_score": value}]))
        assert set(store.refresh_views(AS_OF).values()) == {"refreshed"}
        assert [r["opportunity_score"] for r in rows(store.read_view(board))] == [value]
    assert {view: len(versions(store, view)) for view in store.view_builders(AS_OF)} == dict.fromkeys(store.view_builders(AS_OF), 1)

    before, real = versions(store, board), store.view_builders
    fails = {board: lambda: store.read("niche_scores").selectExpr("category_name", "raise_error('late') AS opportunity_score")}
    monkeypatch.setattr(store, "view_builders", lambda as_of, dates=None: {**real(as_of, dates), **fails})
    assert store.refresh_views(AS_OF)[board].startswith("failed")
    assert versions(store, board) == before and [r["opportunity_score"] for r in rows(store.read_view(board))] == [7]
    monkeypatch.undo()

    reader = store.read_view(board)
    store.refresh_views(AS_OF, keep=2)
    assert len(versions(store, board)) == 2 and reader.count() == 1


def test_back_fill_gives_the_day_its_own_views(store, make):
    days = [date(2024, 6, d) for d in (28, 29, 30)]
    for i, d in enumerate(days):
        store.load_niche_scores(make("niche_scores", [{"category_name": c, "scored_at": d, "opportunity_score": 10 * i + n, "recommendation": "enter"} for n, c in enumerate("AB", 60)]))
        store.load_category_trends(make("category_trends", [{"category_name": c, "source": "ebay", "snapshot_date": d, "avg_price": 20 + i, "listing_count": i} for c in "AB"]))
        store.load_consumer_spend(make("consumer_spend", [{"category_name": "A", "year": 2023 + i, "avg_annual_spend": i}]))
        store.load_retail_vs_ecomm(make("retail_vs_ecomm", [{"category_name": "A", "period_date": d, "source": "derived", "ecomm_share": 0.1 * (i + 1)}]))
    names = ["mv_category_leaderboard", "mv_niche_finder"]
    seen = []
    for d in (days[1], days[2], days[1]):
        store.refresh_views(d)
        seen.append({name: content(store.read_view(name)) for name in names})
    assert seen[0] == seen[2] != seen[1]
    board = {r["category_name"]: r for r in rows(store.read_view("mv_category_leaderboard"))}
    assert board["A"]["scored_at"] == days[1] and board["A"]["score_delta"] == 10 and board["A"]["avg_price"] == 21
    niche = {r["category_name"]: r for r in rows(store.read_view("mv_niche_finder"))}
    assert (niche["A"]["avg_price"], niche["A"]["avg_annual_spend"]) == (21, 1)
    tables = [store.read(t) for t in ("niche_scores", "category_trends", "retail_vs_ecomm")]
    entry = {r["category_name"]: r for r in rows(analytics.cte_top_entries(*tables, days[1]))}
    assert (entry["A"]["opportunity_score"], entry["A"]["avg_price"], entry["A"]["ecomm_share"]) == (70, 21, Decimal("0.2"))
    empty = {t: store.read(t) for t in ("search_signals", "social_buzz", "consumer_spend")}
    rising = rows(analytics.cte_rising_categories(tables[0], tables[1], *empty.values(), days[1]))
    assert {r["opportunity_score"] for r in rising} == {70, 71}
    table = rows(analytics.cte_score_breakdown(tables[0], tables[1], *empty.values(), tables[2], days[0]))
    assert {r["opportunity_score"] for r in table} == {60, 61}


def test_series_is_renewed_by_day(store, make, tmp_path):
    def listing(day, count):
        return {"category_name": "A", "source": "ebay", "snapshot_date": day, "listing_count": count}

    store.load_category_trends(make("category_trends", [listing("2024-06-28", 1), listing("2024-06-29", 2)]))
    store.refresh_views(AS_OF)
    (version,) = versions(store, SERIES)
    old = tmp_path / "views" / SERIES / version / "snapshot_date=2024-06-28"
    before = sorted(p.name for p in old.iterdir())
    loaded = store.load_category_trends(make("category_trends", [listing("2024-06-29", 3), listing("2024-06-30", 4)]))
    assert loaded == 2 and loaded.partitions == {date(2024, 6, 29), AS_OF}
    loaded = loaded.partitions | store.load_search_signals(make("search_signals", [signal("a", 9, "2024-06-29")])).partitions
    plan = store.view_builders(AS_OF, loaded)[SERIES]()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == plan.count("PartitionFilters: [snapshot_date") + plan.count("PartitionFilters: [isnotnull(snapshot_date") >= 2
    store.refresh_views(AS_OF, loaded)
    assert versions(store, SERIES) == [version] and sorted(p.name for p in old.iterdir()) == before
    renewed = content(store.read_view(SERIES))
    store.refresh_views(AS_OF)
    assert content(store.read_view(SERIES)) == renewed and [(r[4], float(r[6])) for r in renewed] == [(1, 0.0), (3, 9.0), (4, 0.0)]
    store.refresh_views(AS_OF, set())
    assert content(store.read_view(SERIES)) == renewed


def test_momentum_over_new_days_equals_the_whole(store, make):
    import random

    rng = random.Random(1)
    days = [date(2024, 5, 1) + timedelta(days=i) for i in range(30)]

    def load(some):
        touched = store.load_category_trends(make("category_trends", [
            {"category_name": c, "source": s, "snapshot_date": d, "listing_count": rng.randrange(99), "sell_through": rng.choice([None, 0.1, 0.33])}
            for d in some for c in "ABC" for s in ("ebay", "amazon_bsr") if rng.random() < 0.6])).partitions
        touched |= store.load_search_signals(make("search_signals", [signal(k, rng.randrange(100), str(d)) for d in some for k in "kl" if rng.random() < 0.8])).partitions
        touched |= store.load_social_buzz(make("social_buzz", [
            {"category_name": c, "keyword": f"k{c}", "subreddit": "s", "snapshot_date": d, "mention_count": rng.randrange(4)} for d in some for c in "AB"])).partitions
        return touched

    whole = {"wf_sell_through_delta": windows.wf_sell_through_delta, "wf_moving_avg": windows.wf_moving_avg,
             "wf_interest_momentum": windows.wf_interest_momentum, "wf_buzz_momentum": windows.wf_buzz_momentum}
    # first days, a gap, one day, several, and at last rows of days that were there before
    for some in (days[:12], days[15:16], days[16:20], days[20:22], days[10:18]):
        store.refresh_momentum(load(some))
        for name, query in whole.items():
            expected = query(store.read(increments.MOMENTUM[name].table))
            got = store.read_momentum(name).select(expected.columns)
            assert content(got) == content(expected), (name, some[0])
    tail = spark_plan(increments.with_tail("wf_moving_avg", store.read("category_trends"), days[20], store.spark.read.parquet(store._current(store.tail_path("wf_moving_avg")))))
    assert "snapshot_date" in tail.split("PartitionFilters: [")[-1].split("]")[0] and "19" in tail


def spark_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def daily_feeds(spark, price):
    listings = spark.createDataFrame(
        [(c, "1", n, [((str(price),), ["FIXED_PRICE"])]) for c, n in (("Electronics", 10), ("Collectibles", 20))], schemas.LISTING_FEED
    )
    search = spark.sql("SELECT 'gadgets online' AS keyword, TIMESTAMP_NTZ'2024-06-29 00:00:00' AS point_ts, 55D AS interest")
    posts = spark.createDataFrame([("flipping", "electronics", 1, 1719700000.0, 3.0)], schemas.POST_FEED)
    spend = spark.createDataFrame([("Reading", 2023, 110.0, 100.0)], schemas.SPEND_FEED)
    ranked = spark.createDataFrame([("bestsellers_electronics", [((9.0,),), ((8.0,),)])], schemas.RANKED_FEED)
    return DailyFeeds(listings, search, posts, spend, ranked)


def test_daily_job_runs_twice_with_one_result(spark, store):
    report = run_daily(store, daily_feeds(spark, 30), AS_OF)
    assert report == {
        "category_trends": 3, "search_signals": 1, "social_buzz": 60, "consumer_spend": 1, "retail_vs_ecomm": 10, "niche_scores": 2,
        "mv_category_leaderboard": "refreshed", "mv_channel_comparison": "refreshed", "mv_niche_finder": "refreshed",
        "mv_trends_explorer": "refreshed",
    }
    first = {t: content(store.read(t)) for t in schemas.TABLES}
    assert run_daily(store, daily_feeds(spark, 30), AS_OF) == report
    assert {t: content(store.read(t)) for t in schemas.TABLES} == first
    ranked = store.read("category_trends").where("source = 'amazon_bsr'")
    assert [(r["avg_price"], r["rank_position"], r["listing_count"]) for r in rows(ranked)] == [(9, 1, 0)]

    # the next day: both days are kept, the read models show the newer one
    later = date(2024, 7, 1)
    run_daily(store, daily_feeds(spark, 40), later)
    assert store.read("niche_scores").count() == 4
    board = rows(store.read_view("mv_category_leaderboard"))
    assert len(board) == 2 and {r["scored_at"] for r in board} == {later}


def with_total_spend(raw, spark):
    """The feeds with totals of all orders for spend, beyond 10 digits before the point."""
    raw.spend = spark.createDataFrame([("Entertainment", 2024, 68556301169.4, 34278150584.7)], schemas.SPEND_FEED)
    return raw


def test_daily_job_holds_totals_of_all_orders(spark, store):
    # over files of the narrower type
    narrow = "'Electronics' AS category_name, 'Other' AS bls_category, CAST(12.34 AS decimal(12,2)) AS avg_annual_spend"
    old = spark.sql(f"SELECT {narrow}, CAST(0.1 AS decimal(8,4)) AS yoy_change, 2024 AS year")
    old.write.partitionBy("year").parquet(store.table_path("consumer_spend"))
    report = run_daily(store, with_total_spend(daily_feeds(spark, 30), spark), AS_OF)
    assert report["consumer_spend"] == 1 and report["mv_category_leaderboard"] == "refreshed"
    spend = {r["bls_category"]: r["avg_annual_spend"] for r in rows(store.read("consumer_spend"))}
    assert spend == {"Entertainment": Decimal("68556301169.40"), "Other": Decimal("12.34")}


class Lost(Exception):
    """The driver is gone."""


def test_a_lost_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    whole, cut = SignalStore(spark, str(tmp_path / "whole")), SignalStore(spark, str(tmp_path / "cut"))
    named = daily_feeds(spark, 30)
    named.input_id = "files of the day"
    report = run_daily(whole, named, AS_OF)

    def lost(*args):
        raise Lost

    for stage in ("load_social_buzz", "load_niche_scores", "refresh_views"):
        monkeypatch.setattr(cut, stage, lost)
        with pytest.raises(Lost):
            run_daily(cut, named, AS_OF)
        monkeypatch.undo()
    ran = []
    for name in ("load_category_trends", "load_search_signals", "load_social_buzz", "load_consumer_spend", "load_niche_scores"):
        monkeypatch.setattr(cut, name, lambda *args, name=name, real=getattr(cut, name): ran.append(name) or real(*args))
    assert run_daily(cut, named, AS_OF) == report and ran == []
    for table in schemas.TABLES:
        assert content(cut.read(table)) == content(whole.read(table)), table
    # another input of the same day is another run
    named.input_id = "files that came later"
    assert run_daily(cut, named, AS_OF) == report and len(ran) == 5


def test_a_lost_run_holds_totals_of_all_orders(spark, store):
    named = with_total_spend(daily_feeds(spark, 30), spark)
    named.input_id = "files of the day"
    loads = load_day(store, named, AS_OF)
    report = run_daily(SignalStore(spark, store.root), named, AS_OF)
    assert loads["consumer_spend"] == report["consumer_spend"] == 1
    assert [r["avg_annual_spend"] for r in rows(store.read_view("mv_niche_finder")) if r["category_name"] == "Electronics"] == [None]
    assert [r["avg_annual_spend"] for r in rows(store.read("consumer_spend"))] == [Decimal("68556301169.40")]


def test_back_fill_loads_each_day_once_and_equals_daily_runs(spark, tmp_path, monkeypatch):
    daily, filled = SignalStore(spark, str(tmp_path / "daily")), SignalStore(spark, str(tmp_path / "filled"))
    days = {date(2024, 6, 29): daily_feeds(spark, 30), AS_OF: daily_feeds(spark, 40), date(2024, 7, 1): daily_feeds(spark, 50)}
    for d, raw in days.items():
        raw.input_id = f"landed {d}"
        run_daily(daily, raw, d)
    scored = []
    real = filled.load_niche_scores
    monkeypatch.setattr(filled, "load_niche_scores", lambda batch: scored.append(1) or real(batch))
    reports = run_backfill(filled, days)
    assert list(reports) == sorted(days) and len(scored) == 1 and reports[AS_OF]["niche_scores"] == 2
    for table in schemas.TABLES:
        assert content(filled.read(table)) == content(daily.read(table)), table
    for view in filled.view_builders(AS_OF):
        assert content(filled.read_view(view)) == content(daily.read_view(view)), view
    monkeypatch.setattr(filled, "upsert", lambda *args: pytest.fail("a finished stage ran again"))
    assert {d: r["niche_scores"] for d, r in run_backfill(filled, days).items()} == dict.fromkeys(days, 2)
    assert run_backfill(filled, {}) == {}


def test_rows_that_cannot_be_cleaned_are_kept_aside(spark, store):
    raw = daily_feeds(spark, 30)
    nameless = spark.createDataFrame([(None, "9", 1, [(("1",), ["AUCTION"])])], schemas.LISTING_FEED)
    raw.listings = raw.listings.unionByName(nameless)
    for _ in range(2):
        report = run_daily(store, raw, AS_OF)
        assert report["category_trends"] == 3 and report["category_trends_rejected"] == 1
        (record,) = rows(store.read_rejects("category_trends"))
        assert (record["reason"], record["run_date"]) == ("no category_name", AS_OF) and '"category_id":"9"' in record["record"]
    assert store.read_rejects("social_buzz").count() == 0


def test_folder_names_and_texts(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "new folder"))
    assert folder.names() == [] and folder.read("x") is None
    for text in ("eins", "zwei — ü"):
        folder.replace("x", text)
        assert folder.read("x") == text
    assert [n for n in folder.names() if not n.startswith(".")] == ["x"]
    folder.delete("x")
    folder.delete("x")
    assert folder.read("x") is None


def test_no_shared_folder_is_an_error_on_a_cluster(monkeypatch):
    class Unset:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:  # noqa: N801
            applicationId = "app-without-a-folder"
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Unset)
    Unset.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Unset)
    Unset.sparkContext.master = "local[4]"
    assert shared.shared_folder(Unset) == shared.shared_folder(Unset)


def test_daily_job_without_second_source(spark, store):
    feeds = daily_feeds(spark, 30)
    feeds.bestsellers = None
    assert run_daily(store, feeds, AS_OF)["category_trends"] == 2


def test_newest_run_prunes_partitions(store, make):
    for day in ("2024-06-29", "2024-06-30"):
        store.load_niche_scores(make("niche_scores", [{"category_name": "A", "scored_at": day, "opportunity_score": 5}]))
    newest = newest_run(store.read("niche_scores"))
    assert [r["scored_at"] for r in rows(newest)] == [AS_OF]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scored_at" in plan and "scored_at" in plan.split("Subquery")[0]


def test_shared_folder_follows_the_session(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = own_folder(spark), own_folder(spark)
    assert first.startswith(f"{shared}/signals-") and first != second


def test_batches_without_a_safe_key_are_refused_whole(spark, make, tmp_path):
    store = SignalStore(spark, str(tmp_path / "keyed"))
    one = dict(keyword="a", category_name="A", snapshot_date="2024-06-01", interest_score=1, geo="US")
    store.load_search_signals(make("search_signals", [one]))
    for bad in ([one, {**one, "interest_score": 2}], [{**one, "snapshot_date": None}], [{**one, "keyword": None}]):
        with pytest.raises(ValueError):
            store.load_search_signals(make("search_signals", bad))
    twice = make("search_signals", [{**one, "interest_score": 2}, {**one, "interest_score": 3}])
    store.load_search_signals(twice, [F.col("interest_score").desc()])
    store.load_search_signals(twice, [F.col("interest_score").desc()])
    assert [r["interest_score"] for r in store.read("search_signals").collect()] == [3]
