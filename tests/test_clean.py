"""Cleaning: the edge rows of each feed."""

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from tradewind import catalog, schemas
from tradewind.functions.text import normalize_category
from tradewind.plans import clean
from tradewind.sources import quarantine
from tradewind.sources.arrival import with_arrival

DAY = "2023-11-05"
LISTING = {
    "category_name": "pet supplies", "category_id": "1281", "source": "ebay", "snapshot_date": DAY, "listing_count": "870",
    "avg_price": "45.25", "sold_count": "115", "sell_through": "0.35", "rank_position": None,
}
SEARCH = {"keyword": "Vinyl Records", "category_name": "Collectibles", "snapshot_date": DAY, "interest_score": "61", "geo": "ca"}
SOCIAL = {
    "category_name": "Toys & Hobbies", "keyword": "Board Games", "subreddit": "thrift", "snapshot_date": DAY,
    "mention_count": "17", "avg_score": "6.25",
}
SPEND = {"category_name": "Collectibles", "bls_category": "Reading", "year": "2021", "avg_annual_spend": "640.00", "yoy_change": "0.08"}
ANY = ["category_name"]  # an order for batches of which no key is there twice


def changed(row, **values):
    return {**row, **values}


@pytest.mark.parametrize(
    ("change", "column", "expected"),
    [
        ({}, "category_name", "Pet Supplies"),
        ({"category_name": "  home & gARDEN\t"}, "category_name", "Home & Garden"),
        ({"category_name": "men's t-shirt 3d"}, "category_name", "Men'S T-Shirt 3D"),
        ({}, "avg_price", Decimal("45.25")),
        ({"avg_price": None}, "avg_price", None),
        ({"avg_price": "n/a"}, "avg_price", None),
        ({"avg_price": "12d"}, "avg_price", None),
        ({"avg_price": " 1e2 "}, "avg_price", Decimal("100.00")),
        # scaled to 12.5 and 0.5: halves go to the even neighbour
        ({"avg_price": "0.125"}, "avg_price", Decimal("0.12")),
        ({"avg_price": "0.375"}, "avg_price", Decimal("0.38")),
        ({"sell_through": "1.5"}, "sell_through", Decimal("1.0000")),
        ({"sell_through": "-0.2"}, "sell_through", Decimal("0.0000")),
        ({"sell_through": None}, "sell_through", None),
        ({"sell_through": "0.0", "sold_count": "0"}, "sell_through", Decimal("0.0000")),
        ({"sold_count": "0"}, "sold_count", 0),
        ({"listing_count": "12.9"}, "listing_count", 12),
        ({"listing_count": "many"}, "listing_count", 0),
        ({"rank_position": "3"}, "rank_position", 3),
        ({"rank_position": "x"}, "rank_position", None),
        ({}, "snapshot_date", date(2023, 11, 5)),
    ],
)
def test_listing_values(batch, change, column, expected):
    cleaned = rows(clean.clean_category_trends(batch([changed(LISTING, **change)]), ANY))
    assert cleaned[0][column] == expected


def test_listing_keeps_first_of_a_key(batch):
    doubled = batch(
        [changed(LISTING, rank_position="2", avg_price="2"), changed(LISTING, rank_position="1", avg_price="1")]
    )
    numbered = doubled.selectExpr("*", "CAST(rank_position AS bigint) AS _arrival")
    by_number = rows(clean.clean_category_trends(numbered, "_arrival"))
    assert [r["avg_price"] for r in by_number] == [Decimal("1.00")]
    by_rank = rows(clean.clean_category_trends(doubled, [doubled.rank_position.cast("int").asc()]))
    assert by_rank[0]["avg_price"] == Decimal("1.00")


def test_hot_key_is_pruned_before_the_exchange(spark):
    hot = spark.range(20000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'toys' ELSE concat('c', id % 50) END AS category_name",
        "'1' AS category_id", "'ebay' AS source", "'2024-06-01' AS snapshot_date", "id AS listing_count",
        "id AS avg_price", "id AS sold_count", "0.5D AS sell_through", "id AS rank_position",
    )
    cleaned = clean.clean_category_trends(hot, [hot.listing_count.asc()])
    assert cleaned.count() == 51
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_in_file_order_whatever_the_packing(spark, batch, tmp_path):
    """Files count by name, rows by place, however many tasks read them and whatever else they read."""
    for number, prices in enumerate([("7", "8"), ("1", "2"), ("3",)]):
        lines = [changed(LISTING, avg_price=p, category_name=f"c {i % 2}") for i, p in enumerate(prices * 400)]
        batch(lines).coalesce(1).write.parquet(str(tmp_path / f"part {number}"))
    scan = spark.read.schema(batch([LISTING]).schema).option("recursiveFileLookup", True).parquet(str(tmp_path))
    for settings in ({}, {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}):
        for key, value in settings.items():
            spark.conf.set(key, value)
        cleaned = clean.clean_category_trends(with_arrival(scan), "_arrival")
        assert {(r["category_name"], r["avg_price"]) for r in rows(cleaned)} == {("C 0", Decimal("7.00")), ("C 1", Decimal("8.00"))}
        for key in settings:
            spark.conf.unset(key)
    ordinals = with_arrival(scan)
    assert ordinals.select("_arrival").distinct().count() == ordinals.count() == 2000


def test_arrival_needs_no_sort_before_the_exchange(spark, batch, tmp_path):
    batch([LISTING]).write.parquet(str(tmp_path / "one"))
    plan = clean.clean_category_trends(with_arrival(spark.read.parquet(str(tmp_path / "one"))), "_arrival")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "SortAggregate" not in text
    assert "HashAggregate" in text[text.rindex("Exchange hashpartitioning"):] and "partial_min" in text


@pytest.mark.parametrize(
    "spelled", ["2023-11-05", "2023-11-05T23:30:00", "11/5/2023", "11/05/2023", "20231105", "5 Nov 2023", "Nov 5, 2023", "november 5, 2023",
                "2023/11/05", " 5-Nov-2023 ", "Sun, 5 Nov 2023", "11/05/2023 08:15"]
)
def test_spellings_of_dates(batch, spelled):
    assert rows(clean.clean_category_trends(batch([changed(LISTING, snapshot_date=spelled)]), ANY))[0]["snapshot_date"] == date(2023, 11, 5)


def test_rows_that_cannot_be_cleaned_are_split_off(batch):
    bad = [{"category_name": None}, {"snapshot_date": "June"}, {"snapshot_date": None}, {"source": None, "snapshot_date": "x"}]
    parts = quarantine.split("category_trends", batch([LISTING, *[changed(LISTING, **b) for b in bad], changed(LISTING, category_name="b")]))
    assert parts.counts == {"no category_name": 1, "no source": 1, "no snapshot_date": 1, "unreadable snapshot_date": 1}
    assert parts.rejects == 4 and clean.clean_category_trends(parts.clean, ANY).count() == 2
    records = rows(quarantine.as_records("category_trends", parts.rejected))
    assert sorted(r["reason"] for r in records) == sorted(parts.counts) and all('"avg_price":"45.25"' in r["record"] for r in records)
    assert quarantine.split("search_signals", batch([changed(SEARCH, geo=None)])).counts == {}
    assert quarantine.split("social_buzz", batch([changed(SOCIAL, subreddit=None)])).counts == {"no subreddit": 1}
    assert quarantine.split("consumer_spend", batch([changed(SPEND, category_name=None)])).counts == {"no category_name": 1}


def test_bad_date_and_missing_category_fail(batch):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        clean.clean_category_trends(batch([changed(LISTING, snapshot_date="June")]), ANY).collect()
    with pytest.raises(Exception, match="category_name must not be NULL"):
        clean.clean_category_trends(batch([changed(LISTING, category_name=None)]), ANY).collect()


@pytest.mark.parametrize("table", ["category_trends", "search_signals", "social_buzz", "consumer_spend"])
def test_empty_in_empty_out(make, table):
    cleaned = getattr(clean, f"clean_{table}")(make(table, []), ANY)
    assert cleaned.count() == 0
    assert cleaned.columns == schemas.TABLES[table].names


@pytest.mark.parametrize(
    ("change", "column", "expected"),
    [
        ({}, "keyword", "vinyl records"),
        ({"keyword": "  Gadgets\n"}, "keyword", "gadgets"),
        ({}, "geo", "CA"),
        ({"geo": None}, "geo", "US"),
        ({"interest_score": "150"}, "interest_score", 100),
        ({"interest_score": "-4"}, "interest_score", 0),
        ({"interest_score": "0"}, "interest_score", 0),
        ({"interest_score": None}, "interest_score", 0),
    ],
)
def test_search_values(batch, change, column, expected):
    assert rows(clean.clean_search_signals(batch([changed(SEARCH, **change)]), ANY))[0][column] == expected


def test_catalogue_names_are_in_normal_form(spark):
    names = spark.createDataFrame([(c,) for c in catalog.CATEGORIES], "c string")
    assert [r[0] for r in names.select(normalize_category("c")).collect()] == catalog.CATEGORIES
    assert [c.strip().title() for c in catalog.CATEGORIES] == catalog.CATEGORIES


@pytest.mark.parametrize(
    "name", ["o'neil & SONS", "3d-PRINTERS", "é\u00e0lan vital", "\u2003em space\u00a0", "日本abc", "x", "", "a_b c1d", "ǆungla", "ÀÉ"]
)
def test_normal_form_equals_strip_and_title(spark, name):
    df = spark.createDataFrame([(name,)], "c string")
    assert df.select(normalize_category("c")).collect()[0][0] == name.strip().title()


def test_search_keeps_every_keyword(batch):
    two = batch([changed(SEARCH, keyword="vinyl records"), changed(SEARCH, keyword="used vinyl")])
    assert clean.clean_search_signals(two, ANY).count() == 2


@pytest.mark.parametrize(
    ("change", "column", "expected"),
    [
        ({}, "mention_count", 17),
        ({"avg_score": None}, "avg_score", Decimal("0.00")),
        ({"subreddit": " Thrift "}, "subreddit", "Thrift"),
        ({"keyword": " BOARD games"}, "keyword", "board games"),
    ],
)
def test_social_values(batch, change, column, expected):
    assert rows(clean.clean_social_buzz(batch([changed(SOCIAL, **change)]), ANY))[0][column] == expected


def test_social_keeps_every_community(batch):
    three = batch([changed(SOCIAL, subreddit=s) for s in ("thrift", "garage_sales", "resale")])
    assert clean.clean_social_buzz(three, ANY).count() == 3


def test_spend_years_and_rounding(batch):
    assert clean.clean_consumer_spend(batch([changed(SPEND, year="1999")]), ANY).count() == 0
    assert rows(clean.clean_consumer_spend(batch([SPEND]), ANY))[0]["year"] == 2021
    rounded = rows(
        clean.clean_consumer_spend(batch([changed(SPEND, avg_annual_spend="987.6543", yoy_change="-0.03217")]), ANY)
    )[0]
    assert rounded["avg_annual_spend"] == Decimal("987.65")
    assert rounded["yoy_change"] == Decimal("-0.0322")


def channel_rows(make, *changes):
    spend = make(
        "consumer_spend",
        [{"category_name": "Electronics", "year": 2020 + i, "yoy_change": c} for i, c in enumerate(changes)],
    )
    return {r["category_name"]: r for r in rows(clean.build_retail_vs_ecomm(spend, date(2024, 6, 1)))}


def test_channel_shares_sum_to_one_for_every_category(make):
    shares = channel_rows(make, 0.04)
    assert list(shares) and set(shares) == set(catalog.BASE_ONLINE_SHARE)
    for row in shares.values():
        assert row["ecomm_share"] + row["retail_share"] == 1
    assert shares["Electronics"]["ecomm_share"] == Decimal("0.6254")
    assert shares["Electronics"]["ecomm_growth"] == Decimal("0.0540")
    assert shares["Electronics"]["retail_growth"] == Decimal("0.0260")
    # a category without spend rows keeps its base share
    assert shares["Collectibles"]["ecomm_share"] == Decimal("0.7000")
    assert shares["Collectibles"]["ecomm_growth"] == 0


def test_channel_share_limits(make):
    assert channel_rows(make, 5.0)["Electronics"]["ecomm_share"] == Decimal("0.9500")
    low = channel_rows(make, -0.99)["Electronics"]
    assert low["ecomm_share"] >= 0 and low["retail_share"] >= 0


def test_channel_mean_keeps_exact_halves(make):
    # 0.0020 / 6 x 1.35 = 0.00045 exactly
    assert channel_rows(make, 0.0020, 0, 0, 0, 0, 0)["Electronics"]["ecomm_growth"] == Decimal("0.0005")


def test_channel_unknown_change_and_empty_spend(make):
    unknown = channel_rows(make, None)["Electronics"]
    assert unknown["ecomm_share"] is None and unknown["ecomm_growth"] is None
    assert channel_rows(make) == {}


def test_union_sources(batch):
    first = clean.clean_category_trends(batch([LISTING]), ANY)
    second = clean.clean_category_trends(batch([changed(LISTING, source="amazon_bsr")]), ANY)
    assert clean.union_sources(first, second).count() == 2
    assert clean.union_sources(first, None) is first
