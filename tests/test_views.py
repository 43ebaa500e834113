"""Read models and the queries on them, on rows that sit on every boundary."""

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from tradewind.plans import analytics, reads, summaries, views, windows

AS_OF = date(2024, 6, 30)


def score(category, day, value, **more):
    return {"category_name": category, "scored_at": day, "opportunity_score": value, "recommendation": "watch", **more}


def by_name(df):
    return {r["category_name"]: r for r in rows(df)}


@pytest.fixture(scope="module")
def scores(make):
    return make(
        "niche_scores",
        [
            score("Up5", "2024-06-23", 50), score("Up5", "2024-06-30", 55),
            score("Up6", "2024-06-23", 50), score("Up6", "2024-06-30", 55.01),
            score("Down5", "2024-06-23", 50), score("Down5", "2024-06-30", 45),
            score("Down6", "2024-06-23", 50), score("Down6", "2024-06-30", 44.99),
            score("New", "2024-06-30", 55),
            score("Left out", "2024-06-16", 10), score("Left out", "2024-06-23", 70, recommendation="enter"),
        ],
    )


@pytest.fixture(scope="module")
def trends(make):
    def line(category, day, source, price, sell=0.2, listings=10):
        return {"category_name": category, "snapshot_date": day, "source": source, "avg_price": price,
                "sell_through": sell, "listing_count": listings, "sold_count": 1}

    return make(
        "category_trends",
        [
            line("Up5", "2024-06-30", "amazon_bsr", 1), line("Up5", "2024-06-30", "ebay", 2),
            line("Up6", "2024-06-29", "ebay", 3), line("Up6", "2024-06-30", "amazon_bsr", 4, None),
        ],
    )


def test_leaderboard_momentum_rank_and_ties(scores, trends):
    board = by_name(views.mv_category_leaderboard(scores, trends))
    momentum = {k: (r["score_delta"], r["momentum"]) for k, r in board.items()}
    assert momentum == {
        "Up5": (Decimal("5.00"), "Stable"),
        "Up6": (Decimal("5.01"), "Rising"),
        "Down5": (Decimal("-5.00"), "Stable"),
        "Down6": (Decimal("-5.01"), "Declining"),
        "New": (Decimal("0.00"), "Stable"),
        # absent from the newest run: compares with itself
        "Left out": (Decimal("0.00"), "Stable"),
    }
    assert {k: r["current_rank"] for k, r in board.items()} == {
        "Left out": 1, "Up6": 2, "Up5": 3, "New": 3, "Down5": 5, "Down6": 6,
    }
    assert board["Up5"]["avg_price"] == 2  # the marketplace row wins a tied date
    assert board["Up6"]["avg_price"] == 4  # any source, newest date
    assert board["New"]["avg_price"] is None


def test_leaderboard_is_sorted_best_first(scores, trends):
    names = [r["category_name"] for r in rows(reads.get_leaderboard(views.mv_category_leaderboard(scores, trends)))]
    assert names == ["Left out", "Up6", "New", "Up5", "Down5", "Down6"]


def channel(category, share, growth, period="2024-06-30"):
    retail = None if share is None else round(1 - share, 4)
    return {"category_name": category, "period_date": period, "ecomm_share": share, "retail_share": retail,
            "ecomm_growth": growth, "retail_growth": 0, "source": "derived"}


def test_channel_labels_on_their_boundaries(make):
    channels = make(
        "retail_vs_ecomm",
        [channel("a", 0.55, 0.05), channel("b", 0.5501, 0.0501), channel("c", 0.30, -0.0001), channel("d", 0.2999, 0.06),
         channel("e", 0.4499, 0.0501), channel("f", 0.45, 0.0501), channel("g", None, None)],
    )
    labels = {k: (r["channel_status"], r["opportunity_label"]) for k, r in by_name(views.mv_channel_comparison(channels)).items()}
    assert labels == {
        "a": ("Contested", "Stable"),
        "b": ("E-comm dominant", "Growing — competitive"),
        "c": ("Contested", "E-comm contracting"),
        "d": ("Retail dominant", "Early mover opportunity"),
        "e": ("Contested", "Early mover opportunity"),
        "f": ("Contested", "Growing — competitive"),
        "g": ("Contested", "Stable"),
    }
    order = [r["category_name"] for r in rows(reads.get_channel_comparison(views.mv_channel_comparison(channels)))]
    assert order[0] == "g"  # unknown growth first when descending


def test_channel_summary_averages_rounded_percents(make):
    channels = make(
        "retail_vs_ecomm",
        [channel("a", 0.3004, 0.01, "2024-06-01"), channel("a", 0.3014, None, "2024-06-02"), channel("a", 0.29, -0.01, "2024-06-03")],
    )
    summary = by_name(reads.get_channel_summary(views.mv_channel_comparison(channels)))["a"]
    # 30.0, 30.1 and 29.0
    assert summary["avg_ecomm_share"] == Decimal("29.7")
    assert summary["avg_ecomm_growth"] == 0
    assert (summary["channel_status"], summary["opportunity_label"]) == ("Retail dominant", "Stable")


@pytest.fixture(scope="module")
def signals(make):
    search = make(
        "search_signals",
        [{"keyword": k, "category_name": "Up5", "snapshot_date": d, "interest_score": s, "geo": g}
         for k, d, s, g in (("x", "2024-06-30", 10, "US"), ("y", "2024-06-30", 15, "US"), ("x", "2024-05-31", 90, "US"),
                            ("x", "2024-05-30", 0, "US"), ("x", "2024-06-30", 99, "CA"))],
    )
    social = make(
        "social_buzz",
        [{"category_name": "Up5", "keyword": "x", "subreddit": s, "snapshot_date": d, "mention_count": m, "avg_score": 1}
         for s, d, m in (("p", "2024-06-30", 4), ("q", "2024-06-23", 5), ("p", "2024-06-22", 100))],
    )
    spend = make("consumer_spend", [{"category_name": "Up5", "year": y, "avg_annual_spend": y, "yoy_change": 0.01} for y in (2022, 2023)])
    return search, social, spend


def test_niche_finder_windows_are_inclusive(scores, trends, signals):
    niches = views.mv_niche_finder(scores, trends, *signals, AS_OF)
    found = by_name(niches)
    row = found["Up5"]
    assert row["avg_interest_30d"] == Decimal("38.3")  # 10, 15 and 90; the 31st day back is out
    assert (row["weekly_mentions"], row["subreddit_count"]) == (9, 2)
    assert (row["avg_annual_spend"], row["spend_growth_pct"]) == (2023, Decimal("1.00"))
    assert found["Up6"]["avg_price"] == 3  # marketplace rows only
    assert found["New"]["weekly_mentions"] is None


def test_trends_explorer_keeps_every_listing_row(trends, signals):
    search, social, _ = signals
    explorer = views.mv_trends_explorer(trends, search, social)
    assert explorer.count() == trends.count()
    series = rows(reads.get_category_timeseries(explorer, "Up5"))
    assert [(r["source"], r["search_interest"], r["reddit_mentions"]) for r in series] == [
        ("amazon_bsr", Decimal("12.5"), 4), ("ebay", Decimal("12.5"), 4),
    ]
    assert {r["search_interest"] for r in rows(reads.get_category_timeseries(explorer, "Up6"))} == {0}


def test_niche_filters(scores, trends, signals):
    niches = views.mv_niche_finder(scores, trends, *signals, AS_OF)

    def names(**filters):
        return {r["category_name"] for r in rows(reads.get_niche_finder(niches, **filters))}

    assert names() == {"Up5", "Up6", "Down5", "Down6", "New", "Left out"}
    assert names(min_score=55) == {"Up5", "Up6", "New", "Left out"}
    assert names(recommendation="enter") == {"Left out"}
    assert names(channel_edge="ecomm") == set()
    assert names(max_price=2) == {"Up5"}  # an unknown price fails
    assert names(max_price=0) == names()
    assert names(recommendation="' OR '1'='1") == set()
    assert [r["category_name"] for r in rows(reads.get_category_score_breakdown(niches, "Up5"))] == ["Up5"]
    assert [r[0] for r in reads.get_all_category_names(niches).collect()] == sorted(names())


def test_explorer_signal_choice(trends, signals):
    search, social, _ = signals
    explorer = views.mv_trends_explorer(trends, search, social)

    def values(categories, **options):
        return [r["value"] for r in rows(reads.get_trends_explorer(explorer, categories, AS_OF, **options))]

    assert values(["Up6"], signal="avg_price") == [3, 4]
    assert values(["Up6"], signal="dropped_table") == values(["Up6"], signal="sell_through_pct") == [20, None]
    assert values(["Up6"], signal="avg_price", days=0) == [4]
    assert values([]) == []
    assert len(values(["Up5", "Up6", "Absent"])) == 4


def test_buzz_growth_needs_a_previous_count(make):
    social = make(
        "social_buzz",
        [{"category_name": "a", "keyword": "x", "subreddit": "p", "snapshot_date": f"2024-06-0{d}", "mention_count": m}
         for d, m in ((1, 0), (2, 8), (3, 3))],
    )
    growth = [(r["prev_mentions"], r["mention_delta"], r["mention_growth_pct"]) for r in rows(windows.wf_buzz_momentum(social))]
    assert growth == [(8, -5, Decimal("-62.50")), (0, 8, None), (None, None, None)]


def test_deltas_and_moving_average_look_back_in_date_order(make):
    trends = make(
        "category_trends",
        [{"category_name": "a", "source": "ebay", "snapshot_date": f"2024-06-{d:02d}", "sell_through": s, "listing_count": d}
         for d, s in ((1, 0.1), (2, None), (3, 0.4), (4, 0.2), (5, 0.3))],
    )
    delta = [r["sell_through_delta"] for r in rows(windows.wf_sell_through_delta(trends))]
    assert delta == [Decimal("10.00"), Decimal("-20.00"), None, None, None]
    moving = [r["moving_avg_4w"] for r in rows(windows.wf_moving_avg(trends))]
    assert moving == [Decimal("0.3000"), Decimal("0.2333"), Decimal("0.2500"), Decimal("0.1000"), Decimal("0.1000")]


def test_rank_change_is_positive_when_a_category_falls(make):
    scores = make("niche_scores", [score("a", "2024-06-01", 9), score("b", "2024-06-01", 8), score("a", "2024-06-02", 7),
                                   score("b", "2024-06-02", 8), score("c", "2024-06-02", 7)])
    newest = {r["category_name"]: (r["rank_this_week"], r["rank_last_week"], r["rank_change"])
              for r in rows(windows.wf_rank_change(scores)) if r["scored_at"] == date(2024, 6, 2)}
    assert newest == {"a": (2, 1, 1), "b": (1, 2, -1), "c": (2, None, None)}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 10, 11])
def test_percentile_and_quartile_equal_the_builtin_windows(spark, make, size):
    trends = make(
        "category_trends",
        [{"category_name": f"c{i:02d}", "source": "ebay", "snapshot_date": AS_OF,
          "sell_through": None if i % 5 == 4 else (i * 7 % 4) / 10} for i in range(size)],
    )
    trends.createOrReplaceTempView("percentile_rows")
    builtin = spark.sql(
        "SELECT category_name, round(CAST(percent_rank() OVER (ORDER BY sell_through NULLS LAST) * 100 AS decimal(20,10)), 1) AS p, "
        "ntile(4) OVER (ORDER BY sell_through NULLS LAST, category_name, source) AS q FROM percentile_rows"
    )
    expected = {r["category_name"]: (r["p"], r["q"]) for r in rows(builtin)}
    got = {r["category_name"]: (r["sell_through_percentile"], r["demand_quartile"]) for r in rows(windows.wf_percentile(trends, AS_OF))}
    assert got == expected


def test_deep_dive(scores, trends, signals):
    search, social, _ = signals
    points = rows(analytics.cte_deep_dive(scores, trends, search, social, "Up5"))
    kinds = [(r["signal_type"], r["period"].isoformat(), r["value"]) for r in points]
    assert ("interest", "2024-06-30", Decimal("12.50")) in kinds and len(kinds) == 8
    assert {r["opportunity_score"] for r in points} == {55}
    assert len(rows(analytics.cte_deep_dive(scores, trends, search, social, "Up5", points=1))) == 3
    assert rows(analytics.cte_deep_dive(scores, trends, search, social, "Never scored")) == []


def test_top_entries_filters(make):
    scores = make("niche_scores", [score(c, "2024-06-30", v, recommendation=r) for c, v, r in
                                   (("a", 70, "enter"), ("b", 70, "enter"), ("c", 59, "enter"), ("d", 70, "watch"), ("e", 66, "enter"))])
    trends = make("category_trends", [{"category_name": c, "source": "ebay", "snapshot_date": AS_OF, "avg_price": p, "sell_through": 0.1}
                                      for c, p in (("a", 15), ("b", 200.01), ("c", 20), ("d", 20))])
    channels = make("retail_vs_ecomm", [channel("a", 0.5, 0.1), channel("a", 0.4, 0.1, "2024-05-30")])
    found = rows(analytics.cte_top_entries(scores, trends, channels, AS_OF))
    assert [(r["category_name"], r["ecomm_share"]) for r in found] == [("a", Decimal("0.5000"))]


def test_rising_flags_and_multiplicity(make):
    scores = make("niche_scores", [score("a", "2024-06-30", 70), score("b", "2024-06-30", 60)])
    trends = make("category_trends", [{"category_name": "a", "source": s, "snapshot_date": AS_OF, "sell_through": v}
                                      for s, v in (("ebay", 0.1501), ("amazon_bsr", 0.15))])
    search = make("search_signals", [{"keyword": "x", "category_name": "a", "snapshot_date": f"2024-06-{d}", "interest_score": v, "geo": "US"}
                                     for d, v in ((27, 5), (28, 1), (30, 2))])
    social = make("social_buzz", [{"category_name": "a", "keyword": "x", "subreddit": "p", "snapshot_date": f"2024-06-{d}", "mention_count": v}
                                  for d, v in ((29, 1), (30, 1))])
    spend = make("consumer_spend", [{"category_name": "a", "year": 2023, "yoy_change": 0.01}])
    frames = (scores, trends, search, social, spend, AS_OF)
    single = by_name(analytics.cte_rising_categories(*frames))
    assert (single["a"]["signals_positive"], single["a"]["momentum_label"]) == (3, "Rising")
    assert (single["b"]["signals_positive"], single["b"]["momentum_label"]) == (0, "Declining")
    many = rows(analytics.cte_rising_categories(*frames, per_date=True))
    assert len(many) == 3 * 2 * 2 + 1


def test_breakdown_sorts_unscored_last_and_fills_zero(make):
    scores = make("niche_scores", [score("a", "2024-06-30", 70), score("b", "2024-06-29", 99)])
    trends = make("category_trends", [{"category_name": c, "source": "ebay", "snapshot_date": AS_OF} for c in ("a", "b")])
    empty = {t: make(t, []) for t in ("search_signals", "social_buzz", "consumer_spend", "retail_vs_ecomm")}
    table = rows(analytics.cte_score_breakdown(scores, trends, *empty.values(), AS_OF))
    assert [(r["category_name"], r["opportunity_score"], r["avg_price"], r["buzz_mentions"]) for r in table] == [
        ("a", 70, 0, 0), ("b", None, 0, 0),
    ]


def test_dashboard_figures(scores, trends, signals):
    board = views.mv_category_leaderboard(scores, trends)
    counts = {r["momentum"]: r["categories"] for r in rows(summaries.momentum_counts(board))}
    assert counts == {"Rising": 1, "Declining": 1, "Stable": 4} and sum(counts.values()) == board.count()
    gauge = rows(summaries.market_gauge(board))[0]
    assert (gauge["categories"], gauge["top_category"], gauge["top_score"]) == (6, "Left out", 70)
    assert gauge["reference_score"] == gauge["avg_score"] - gauge["avg_delta"]
    lines = {r["category_name"]: r["scores"] for r in rows(summaries.score_sparkline(reads.get_score_history(scores)))}
    assert lines["Left out"] == [10, 70] and "New" not in lines
    kpis = rows(summaries.niche_kpis(reads.get_niche_finder(views.mv_niche_finder(scores, trends, *signals, AS_OF), min_score=55)))[0]
    assert (kpis["matched"], kpis["enter"]) == (4, 1)
    assert {r["component"] for r in rows(summaries.avg_component_scores(board))} == {
        "trend_score", "buzz_score", "demand_score", "spend_score", "competition_score",
    }


def test_latest_values_skip_unknown_ones(trends, signals):
    search, social, _ = signals
    explorer = views.mv_trends_explorer(trends, search, social)
    series = reads.get_trends_explorer(explorer, ["Up5", "Up6"], AS_OF, "sell_through_pct")
    assert {r["category_name"]: r["value"] for r in rows(summaries.latest_values(series))} == {"Up5": 20, "Up6": 20}
    assert len(rows(summaries.latest_values(series, shown=1))) == 1
