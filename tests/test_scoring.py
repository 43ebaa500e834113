"""Scoring against a plain-Python computation, and its edge cases."""

import random
from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest
from conftest import rows

from tradewind import catalog
from tradewind.operators.normalize import with_minmax
from tradewind.plans import scoring

AS_OF = date(2024, 6, 30)
CATEGORIES = ["A", "B", "C", "D", "E"]


def test_weights_sum_to_one():
    assert sum(catalog.SCORE_WEIGHTS.values()) == 1.0


def history(seed=3):
    rng = random.Random(seed)
    days = [AS_OF - timedelta(days=n) for n in range(40)]
    trends = [
        {"category_name": c, "source": s, "snapshot_date": d, "listing_count": rng.randint(0, 5000),
         "sell_through": rng.choice([None, round(rng.random(), 4)]) if s == "amazon_bsr" else round(rng.random(), 4)}
        for c in CATEGORIES for d in days for s in ("ebay", "amazon_bsr") if not (c == "E" and d == AS_OF)
    ]
    search = [
        {"keyword": f"{c}{k}", "category_name": c, "snapshot_date": d, "interest_score": rng.randint(0, 100), "geo": g}
        for c in CATEGORIES[:4] for k in range(2) for d in days[::3] for g in ("US", "CA")
    ]
    social = [
        {"category_name": c, "keyword": c, "subreddit": s, "snapshot_date": d, "mention_count": rng.randint(0, 50)}
        for c in CATEGORIES[1:] for s in ("x", "y") for d in days
    ]
    spend = [
        {"category_name": c, "year": y, "yoy_change": round(rng.uniform(-0.2, 0.2), 4)}
        for c in CATEGORIES[:3] for y in range(2018, 2025)
    ]
    return trends, search, social, spend


def expected_scores(trends, search, social, spend, as_of):
    """Straight from the definition, with the fan-out of one trend row per date."""

    def mean(values):
        values = [v for v in values if v is not None]
        return sum(map(float, values)) / len(values) if values else None

    def within(row, days):
        return as_of - timedelta(days=days) <= row["snapshot_date"] <= as_of

    lines = []
    for c in CATEGORIES:
        today = [t for t in trends if t["category_name"] == c and t["snapshot_date"] == as_of]
        if not today:
            continue
        sell = mean([t["sell_through"] for t in today]) or 0.0
        listings = mean([t["listing_count"] for t in today])
        buzz = sum(s["mention_count"] for s in social if s["category_name"] == c and within(s, 7))
        growth = mean([s["yoy_change"] for s in spend if s["category_name"] == c and as_of.year - 2 <= s["year"] <= as_of.year]) or 0.0
        mine = [s for s in search if s["category_name"] == c and within(s, 30)]
        dates = sorted({s["snapshot_date"] for s in mine}) or [None]
        for d in dates:
            trend = mean([s["interest_score"] for s in mine if s["snapshot_date"] == d]) or 0.0
            lines.append((c, d, trend, float(buzz), sell * 100, growth * 100, 1 / (listings + 1) * 10000))

    def scale(values):
        values = np.array(values)
        low, high = values.min(), values.max()
        return np.full(len(values), 50.0) if low == high else ((values - low) / (high - low) * 100).round(2)

    parts = [scale([line[i] for line in lines]) for i in range(2, 7)]
    total = (parts[0] * 0.25 + parts[1] * 0.20 + parts[2] * 0.30 + parts[3] * 0.15 + parts[4] * 0.10).round(2)
    result = {}
    for i, line in enumerate(lines):  # dates ascend: the newest stays
        result[line[0]] = [Decimal(f"{p[i]:.2f}") for p in parts] + [Decimal(f"{total[i]:.2f}")]
    return result


COMPONENTS = [*catalog.SCORE_WEIGHTS, "opportunity_score"]


@pytest.mark.parametrize("seed", [3, 4])
def test_scores_equal_the_definition(make, seed):
    data = history(seed)
    frames = [make(t, r) for t, r in zip(("category_trends", "search_signals", "social_buzz", "consumer_spend"), data)]
    scored = {r["category_name"]: [r[c] for c in COMPONENTS] for r in rows(scoring.niche_scores(*frames, AS_OF))}
    expected = expected_scores(*data, AS_OF)
    assert scored.keys() == expected.keys() and "E" not in scored
    for c, values in expected.items():
        # sums of decimals are exact here and binary there: one unit in the last place may differ
        assert all(abs(a - b) <= Decimal("0.01") for a, b in zip(scored[c], values)), c


def test_many_dates_equal_single_dates(make):
    frames = [make(t, r) for t, r in zip(("category_trends", "search_signals", "social_buzz", "consumer_spend"), history())]
    dates = [AS_OF, AS_OF - timedelta(days=1), AS_OF - timedelta(days=9)]
    together = sorted(map(tuple, scoring.niche_scores(*frames, dates).collect()))
    apart = sorted(tuple(r) for d in dates for r in scoring.niche_scores(*frames, d).collect())
    assert together == apart and len(together) == 14


def test_nothing_listed_means_nothing_scored(make):
    trends, *others = history()
    frames = [make(t, r) for t, r in zip(("search_signals", "social_buzz", "consumer_spend"), others)]
    assert scoring.niche_scores(make("category_trends", []), *frames, AS_OF).count() == 0


def test_equal_values_scale_to_fifty(spark):
    df = spark.createDataFrame([("a", 1, 7.0), ("a", 2, 7.0), ("b", 1, 0.0), ("b", 2, 3.0), ("b", 3, 1.0)], "g string, n int, v double")
    scaled = {(r["g"], r["n"]): r["s"] for r in rows(with_minmax(df, "v", "s", ["g"]))}
    assert scaled == {("a", 1): 50.0, ("a", 2): 50.0, ("b", 1): 0.0, ("b", 2): 100.0, ("b", 3): 33.33}


def test_label_thresholds(spark):
    values = [34.99, 35.0, 60.0, 60.01, 39.99, 40.0, 64.99, 65.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    edges = [r[0] for r in df.select(scoring.channel_edge("v")).collect()]
    assert edges == ["retail", "mixed", "mixed", "ecomm", "mixed", "mixed", "ecomm", "ecomm"]
    labels = [r[0] for r in df.select(scoring.recommendation("v")).collect()]
    assert labels == ["avoid", "avoid", "watch", "watch", "avoid", "watch", "watch", "enter"]


def test_minmax_keeps_rows_of_a_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 4.0)], "g string, v double")
    assert sorted(r["s"] for r in rows(with_minmax(df, "v", "s", ["g"]))) == [0.0, 50.0, 100.0]
