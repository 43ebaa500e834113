"""What the physical plans must hold, whatever the size of the data (see also test_oracle)."""

import re

import pytest

from pyspark.sql import functions as F

from tradewind.operators.ranking import in_ranges, with_position, with_rank, with_rows_ahead
from tradewind.testbed.registry import build_queries

SMALL = "/root/testdata/sf0.001"
QUERIES = build_queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("name", "columns", "pushed"),
    [
        ("category_trends", "l_partkey l_suppkey l_quantity l_extendedprice l_returnflag l_shipdate", ""),
        ("consumer_spend", "o_custkey o_totalprice o_orderdate", ""),
        ("retail_vs_ecomm", "o_orderkey o_custkey o_orderdate", ""),
        ("search_signals", "ts user_id event_type value", "In(event_type"),
        ("social_buzz", "event_id ts user_id event_type value", "Not(In(event_type"),
    ],
)
def test_scans_read_only_what_they_need(spark, name, columns, pushed):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert re.search(r"ReadSchema: struct<([^>]*)>", plan)
    read = [c.split(":")[0] for c in re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1).split(",")]
    assert read == columns.split()
    assert pushed in plan


@pytest.mark.parametrize("name", ["category_trends", "search_signals", "social_buzz", "consumer_spend", "retail_vs_ecomm", "src_listings"])
def test_raw_rows_are_reduced_before_the_exchange(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    first_exchange = plan.rindex("Exchange hashpartitioning")
    below = plan[first_exchange:]
    assert "HashAggregate" in below and "partial_" in below


@pytest.mark.parametrize("name", ["union_sources", "latest_list_entries"])
def test_top_rows_are_pruned_before_the_exchange(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


@pytest.mark.parametrize("name", ["clean_category_trends", "clean_search_signals", "clean_social_buzz", "clean_consumer_spend"])
def test_first_rows_come_from_a_hash_aggregate(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "partial_min" in plan and "Window" not in plan and "SortAggregate" not in plan


def test_a_hot_list_is_ranked_by_many_tasks(spark):
    items = spark.range(30000).selectExpr("CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('l', id % 100) END AS list_type", "id * 7919 % 30011 AS price", "id")
    order = [F.col("price").desc(), F.col("id")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would go to one task
    try:
        ranges = in_ranges(items, ["list_type"], order)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = ranges.where("list_type = 'hot'").groupBy("_range").count().collect()
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 10000
    placed = with_position(items, ["list_type"], order)
    assert "Window" not in plan_of(ranges) and plan_of(placed).count("Window") <= 2
    expected = items.selectExpr("*", "row_number() OVER (PARTITION BY list_type ORDER BY price DESC, id) AS _position")
    assert placed.select("id", "_position").exceptAll(expected.select("id", F.col("_position").cast("bigint"))).isEmpty()
    assert placed.count() == 30000


def test_positions_of_a_null_group_and_of_nothing(spark):
    items = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "g string, v int")
    assert {tuple(r) for r in with_position(items, ["g"], [F.col("v")]).collect()} == {(None, 1, 1), (None, 2, 2), ("a", 5, 1)}
    assert with_position(items.where("false"), ["g"], [F.col("v")]).count() == 0


@pytest.mark.parametrize("name", ["build_retail_vs_ecomm"])
def test_spend_is_planned_once(spark, name):
    assert plan_of(QUERIES[name](spark, SMALL)).count("FileScan") == 1


@pytest.mark.parametrize(("name", "column"), [("channels_by_share", "avg_ecomm_share"), ("channels_by_growth", "avg_ecomm_growth")])
def test_channels_are_sorted(spark, name, column):
    values = [r[column] for r in QUERIES[name](spark, SMALL).collect()]
    known = [v for v in values if v is not None]
    assert len(known) > 3 and known == sorted(known, reverse=name == "channels_by_growth")


@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_the_builtin_one_with_ties_and_nulls(spark, descending):
    df = spark.range(500).selectExpr(
        "id", "id % 3 AS g", "CASE WHEN id % 3 = 0 THEN 7.00 WHEN id % 11 = 0 THEN NULL ELSE CAST(id % 17 AS decimal(5,2)) END AS v"
    )
    order = "v DESC NULLS FIRST" if descending else "v ASC NULLS LAST"
    ranked = with_rank(df, "v", "r", ["g"], descending)
    assert ranked.selectExpr("*", f"rank() OVER (PARTITION BY g ORDER BY {order}) AS expected").where("r <> expected").count() == 0
    everywhere = with_rank(df, "v", "r", descending=descending)
    assert everywhere.selectExpr("*", f"rank() OVER (ORDER BY {order}) AS expected").where("r <> expected").count() == 0
    assert ranked.count() == everywhere.count() == 500
    totals = {r["_total"] for r in with_rows_ahead(df, "v", ["g"], descending).collect()}
    assert totals == {166, 167}
