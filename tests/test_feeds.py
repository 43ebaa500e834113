"""Landed feeds, read from files a test writes."""

import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradewind import catalog, schemas
from tradewind.plans import clean
from tradewind.sources import feeds, landing

AS_OF = date(2024, 6, 30)


def write_lines(path, documents):
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


def test_listings_from_json(spark, tmp_path):
    item = {"price": {"value": "10.00"}, "buyingOptions": ["FIXED_PRICE", "BEST_OFFER"]}
    pages = [
        {"category_name": "A", "category_id": "1", "total": 900,
         "itemSummaries": [item, {"price": {"value": "10.01"}, "buyingOptions": ["AUCTION"]}, {"buyingOptions": None}, {"price": None}]},
        {"category_name": "B", "category_id": "2", "itemSummaries": [item]},
        {"category_name": "C", "category_id": "3", "total": 5, "itemSummaries": []},
    ]
    raw = feeds.read_json_feed(spark, write_lines(tmp_path / "listings.json", pages), schemas.LISTING_FEED)
    found = {r["category_name"]: r for r in rows(feeds.src_listings(raw, AS_OF))}
    a, b, c = found["A"], found["B"], found["C"]
    assert (a["listing_count"], a["avg_price"], a["sold_count"], a["sell_through"]) == (900, Decimal("10.01"), 1, Decimal("0.2500"))
    assert (b["listing_count"], b["sell_through"], b["source"], b["rank_position"]) == (1, 1, "ebay", None)
    assert (c["listing_count"], c["avg_price"], c["sold_count"], c["sell_through"]) == (5, None, 0, None)


def test_listing_pages_of_one_category_add_up(spark):
    page = "array(named_struct('price', named_struct('value', CAST(id AS string)), 'buyingOptions', array('FIXED_PRICE')))"
    raw = spark.range(1, 101).selectExpr("'A' AS category_name", "'1' AS category_id", "CAST(NULL AS bigint) AS total", f"{page} AS itemSummaries")
    row = rows(feeds.src_listings(raw, AS_OF))[0]
    assert (row["listing_count"], row["avg_price"], row["sold_count"]) == (100, Decimal("50.50"), 100)


def test_bestsellers_array_and_item_rows_agree(spark, tmp_path):
    lists = [{"list_type": "bestsellers_pet_supplies", "bestsellers": [{"price": {"value": 100.0 - i}} for i in range(60)]},
             {"list_type": "bestsellers_home", "bestsellers": [{"price": {"value": 1.5}}, {}]}]
    raw = feeds.read_json_feed(spark, write_lines(tmp_path / "ranked.json", lists), schemas.RANKED_FEED)
    found = rows(feeds.src_bestsellers(raw, AS_OF))
    pets = [r for r in found if r["category_name"] == "Pet Supplies"]
    assert sorted(r["rank_position"] for r in pets) == list(range(1, 61))
    assert feeds.src_bestsellers(raw, AS_OF, size=50).count() == 52
    assert {r["avg_price"] for r in found if r["category_name"] == "Home"} == {1.5, None}
    items = spark.createDataFrame([("bestsellers_pet_supplies", 100.0 - i) for i in range(60)], "list_type string, price double")
    from_items = rows(feeds.src_bestseller_items(items, [F.col("price").desc()], AS_OF))
    assert sorted(map(str, from_items)) == sorted(map(str, pets))


def test_search_interest_takes_the_last_point(spark):
    points = spark.createDataFrame(
        [("home decor", datetime(2024, 6, d), float(v)) for d, v in ((1, 90), (28, 41), (29, 42.9))]
        + [("home decor", datetime(2024, 7, 15), 7.0), ("home decor", datetime(2024, 3, 29), 7.0), ("garden supplies", datetime(2024, 3, 29), 9.0)]
        + [("untracked", datetime(2024, 6, 1), 5.0)],
        "keyword string, point_ts timestamp_ntz, interest double",
    )
    assert rows(feeds.src_search_interest(points, AS_OF)) == [
        {"keyword": "home decor", "category_name": "Home & Garden", "snapshot_date": AS_OF, "interest_score": 42, "geo": "US"}
    ]


def test_every_post_of_the_week_counts(spark):
    def seconds(day):
        return datetime(2024, 6, day, 23, 0, tzinfo=timezone.utc).timestamp()

    many = [("flipping", "electronics", p, seconds(23 if p <= 10 else 1), 1.0) for p in range(1, 101)]
    many += [("flipping", "electronics", p, seconds(29), 1.0) for p in range(101, 150)]
    few = [("Ebay", "pet supplies", 1, seconds(30), 2.0), ("Ebay", "pet supplies", 2, seconds(30), 3.005), ("Ebay", "pet supplies", 3, seconds(22), 9.0)]
    posts = spark.createDataFrame(many + few, schemas.POST_FEED)
    found = {(r["subreddit"], r["keyword"]): r for r in rows(feeds.src_social_posts(posts, AS_OF))}
    assert len(found) == len(catalog.COMMUNITIES) * len(catalog.COMMUNITY_TERMS)
    assert found["flipping", "electronics"]["mention_count"] == 59
    assert found["Ebay", "pet supplies"]["mention_count"] == 2
    assert found["Ebay", "pet supplies"]["avg_score"] == Decimal("2.50")
    quiet = found["dropship", "home garden"]
    assert (quiet["mention_count"], quiet["avg_score"], quiet["category_name"]) == (0, 0, "Home & Garden")


def test_spend_csv(spark, tmp_path):
    path = tmp_path / "spend.csv"
    path.write_text(
        "category,year,avg_annual_expenditure,prev_year_expenditure\n"
        '"Pets, toys, hobbies",2023,110.555,100\n Reading ,2023,5,0\nFood at home,2023,10,\n'
    )
    found = {r["bls_category"]: r for r in rows(feeds.src_spend_csv(feeds.read_spend_csv(spark, str(path))))}
    assert found["Pets, toys, hobbies"]["category_name"] == "Pet Supplies"
    assert (found["Pets, toys, hobbies"]["avg_annual_spend"], found["Pets, toys, hobbies"]["yoy_change"]) == (Decimal("110.56"), Decimal("0.1056"))
    assert (found["Reading"]["category_name"], found["Reading"]["yoy_change"]) == ("Collectibles", None)
    assert (found["Food at home"]["category_name"], found["Food at home"]["yoy_change"]) == ("Food at home", None)


def test_spend_without_previous_year_and_missing_file(spark, tmp_path):
    plain = spark.createDataFrame([("Vehicles", 2023, 7.0)], "category string, year int, avg_annual_expenditure double")
    row = rows(feeds.src_spend_csv(plain))[0]
    assert (row["category_name"], row["yoy_change"]) == ("Automotive Parts", 0)
    assert feeds.src_spend_csv(feeds.read_spend_csv(spark, str(tmp_path / "absent.csv"))).count() == 0


@pytest.mark.parametrize("name", ["O'Brien", "back\\slash", "a\nb"])
def test_lookup_quotes_values(spark, name):
    df = spark.createDataFrame([(name,), ("other",)], "k string")
    assert [r[0] for r in df.selectExpr(feeds.lookup({name: name + "!"}, "k")).collect()] == [name + "!", None]


def test_truncated_json_lines_are_set_apart(spark, tmp_path):
    good = [json.dumps({"list_type": f"l{i}", "bestsellers": [{"price": {"value": float(i)}}]}) for i in range(300)]
    lines = [*good[:100], good[100][:20], *good[100:200], '{"list_type": "x", "bestsellers": 7}', *good[200:]]
    (tmp_path / "ranked.json").write_text("\n".join(lines))
    landed = landing.land_json(spark, str(tmp_path / "ranked.json"), schemas.RANKED_FEED)
    assert (landed.row_count, landed.damaged_count) == (300, 2)
    ordered = [r["list_type"] for r in landed.rows.orderBy("_arrival").collect()]
    assert ordered == [f"l{i}" for i in range(300)]
    assert [r["line"] for r in landed.damaged.orderBy("_arrival").collect()] == [lines[100], lines[201]]
    assert feeds.src_bestsellers(landed.rows, AS_OF).count() == 300
    with pytest.raises(landing.DamagedFeed, match="2 of 302 lines"):
        landing.land_json(spark, str(tmp_path / "ranked.json"), schemas.RANKED_FEED, most_damaged=0.001)


def test_short_csv_rows_are_set_apart(spark, tmp_path):
    rows_ = ["category,year,avg_annual_expenditure,prev_year_expenditure", "Reading,2023,110,100", "Reading,2023", "Pets,2023,abc,1", "Reading,2023,120,100"]
    (tmp_path / "spend.csv").write_text("\n".join(rows_) + "\n")
    landed = landing.land_spend_csv(spark, str(tmp_path / "spend.csv"), most_damaged=0.6)
    assert (landed.row_count, landed.damaged_count) == (2, 2)
    assert sorted(r["line"] for r in landed.damaged.collect()) == ["Pets,2023,abc,1", "Reading,2023"]
    spend = feeds.src_spend_csv(landed.rows)
    kept = clean.clean_consumer_spend(spend, "_arrival").collect()
    assert [(r["year"], r["avg_annual_spend"], r["yoy_change"]) for r in kept] == [(2023, Decimal("110.00"), Decimal("0.1000"))]
    with pytest.raises(landing.DamagedFeed):
        landing.land_spend_csv(spark, str(tmp_path / "spend.csv"))
    missing = landing.land_spend_csv(spark, str(tmp_path / "none.csv"))
    assert (missing.row_count, missing.damaged_count, feeds.src_spend_csv(missing.rows).count()) == (0, 0, 0)


def test_lines_of_many_blocks_and_files_keep_their_order(spark, tmp_path):
    for number in range(3):
        write_lines(tmp_path / f"{number} part.json", [{"keyword": f"{number}-{i:05d}", "interest": i} for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        landed = landing.land_json(spark, str(tmp_path), schemas.SEARCH_FEED)
        ordered = [r["keyword"] for r in landed.rows.orderBy("_arrival").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert ordered == [f"{n}-{i:05d}" for n in range(3) for i in range(3000)]
