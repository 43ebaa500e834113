"""Signal tables and raw feeds derived from ``lineitem``, ``orders``, ``events`` and ``part``.

Each table is one scan of one raw table and one hash aggregate. Money is summed as whole cents, so
the sums are exact, independent of row order, and stay in fixed-width buffers.
"""

import uuid
from datetime import date
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import catalog, schemas
from tradewind.functions.literals import text_array
from tradewind.functions.numeric import ratio
from tradewind.plans.scoring import score_categories, score_inputs
from tradewind.sources.arrival import ARRIVAL, with_arrival
from tradewind.sources.shared import shared_folder
from tradewind.sources.together import run_together

AS_OF = date(2024, 1, 30)
RUN_DATES = [date(2024, 1, d) for d in (22, 24, 26, 28, 30)]
# Online orders per ten, by category index.
ONLINE_OF_TEN = [6, 3, 4, 3, 5, 4, 3, 2, 5, 7]

_BIGINT, _INT, _DOUBLE, _TEXT, _MOMENT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

# The given tables this package reads. A declared schema spares a job per read.
GIVEN = {
    "lineitem": schemas.table(
        l_orderkey=_BIGINT,
        l_partkey=_BIGINT,
        l_suppkey=_BIGINT,
        l_linenumber=_INT,
        l_quantity=_DOUBLE,
        l_extendedprice=_DOUBLE,
        l_discount=_DOUBLE,
        l_tax=_DOUBLE,
        l_returnflag=_TEXT,
        l_linestatus=_TEXT,
        l_shipdate=_MOMENT,
    ),
    "orders": schemas.table(
        o_orderkey=_BIGINT,
        o_custkey=_BIGINT,
        o_orderstatus=_TEXT,
        o_totalprice=_DOUBLE,
        o_orderdate=_MOMENT,
        o_orderpriority=_TEXT,
    ),
    "events": schemas.table(
        event_id=_BIGINT, ts=_MOMENT, user_id=_BIGINT, event_type=_TEXT, value=_DOUBLE, props=_TEXT
    ),
    "part": schemas.table(
        p_partkey=_BIGINT, p_name=_TEXT, p_brand=_TEXT, p_type=_TEXT, p_size=_INT, p_retailprice=_DOUBLE
    ),
}


def category(index: str) -> str:
    """Catalogue name of a category index 0..9."""
    return f"element_at({text_array(catalog.CATEGORIES)}, CAST({index} AS int) + 1)"


def day_offset(moment: str) -> str:
    return f"datediff({moment}, DATE'1995-01-01') % 30"


def folded_day(moment: str) -> str:
    """Any date folded onto 2024-01-01 .. 2024-01-30."""
    return f"date_add(DATE'2024-01-01', {day_offset(moment)})"


def cents(money: str) -> str:
    return f"CAST(rint({money} * 100) AS bigint)"


def relative_change(value: str, history: str) -> str:
    """(value - previous) / previous to 4 digits, NULL without a previous value other than 0."""
    before = f"lag({value}) OVER ({history})"
    return f"round(try_divide(CAST({value} - {before} AS decimal(22,4)), CAST({before} AS decimal(22,4))), 4)"


SOURCE = f"CASE WHEN l_suppkey % 4 = 0 THEN '{catalog.RANKED_LISTS}' ELSE '{catalog.MARKETPLACE}' END"
SEARCH_EVENT = "event_type IN ('view', 'click')"
KEYWORD = f"concat_ws(' ', lower({category('index')}), event_type)"


class RawData:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.sf_dir}/{name}.parquet")


def own_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares."""
    return f"{shared_folder(spark)}/signals-{uuid.uuid4().hex}"


class SignalTables(RawData):
    """The six signal tables, each built on first use.

    ``reuse`` names the tables a query reads more than once. Those are written to the shared folder and
    read back, as the daily job does: the raw data behind them is scanned once, their plan ends at a
    small file (a few thousand daily aggregates at most) whose size the join planner knows, and the loss
    of an executor costs nothing that is already written.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, reuse: tuple[str, ...] = ()):
        super().__init__(spark, sf_dir)
        self.reuse = reuse

    @cached_property
    def folder(self) -> str:
        return own_folder(self.spark)

    def prepare(self) -> "SignalTables":
        """Write the raw-derived tables to be reused, side by side."""
        wanted = [name for name in self.reuse if name in schemas.TABLES and name != "niche_scores"]
        if wanted and self.folder:
            run_together(self.spark, {name: partial(getattr, self, name) for name in wanted})
        return self

    def _table(self, name: str, df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
        if schema is not None:
            df = schemas.typed(df, schema)
        if name not in self.reuse:
            return df
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def category_trends(self) -> DataFrame:
        daily = (
            self.table("lineitem")
            .selectExpr(
                "l_partkey % 10 AS index",
                f"{SOURCE} AS source",
                f"{folded_day('l_shipdate')} AS snapshot_date",
                f"{cents('l_extendedprice')} AS price",
                "CAST(l_quantity AS bigint) AS quantity",
                "l_returnflag = 'N' AS sold",
            )
            .groupBy("index", "source", "snapshot_date")
            .agg(
                F.expr("count(*) AS listing_count"),
                F.expr("count_if(sold) AS sold_count"),
                F.expr("sum(price) AS price"),
                F.expr("sum(quantity) AS quantity"),
            )
        )
        return self._table(
            "category_trends",
            daily.selectExpr(
                f"{category('index')} AS category_name",
                "index AS category_id",
                "source",
                "snapshot_date",
                "listing_count",
                f"{ratio('price', 'quantity * 2500', 2)} AS avg_price",
                "sold_count",
                f"{ratio('sold_count', 'listing_count', 4)} AS sell_through",
                "NULL AS rank_position",
            ),
            schemas.CATEGORY_TRENDS,
        )

    @cached_property
    def search_signals(self) -> DataFrame:
        daily = (
            self.table("events")
            .where(SEARCH_EVENT)
            .selectExpr(
                "user_id % 10 AS index",
                "event_type",
                "CAST(ts AS date) AS snapshot_date",
                "CASE WHEN user_id % 7 = 0 THEN 'CA' ELSE 'US' END AS geo",
                "value",
            )
            .groupBy("index", "event_type", "snapshot_date", "geo")
            .agg(F.expr("max(value) AS value"))
        )
        return self._table(
            "search_signals",
            daily.selectExpr(
                f"{KEYWORD} AS keyword",
                f"{category('index')} AS category_name",
                "snapshot_date",
                "least(100, floor(value / 5)) AS interest_score",
                "geo",
            ),
            schemas.SEARCH_SIGNALS,
        )

    @cached_property
    def social_buzz(self) -> DataFrame:
        daily = (
            self.table("events")
            .where(f"NOT {SEARCH_EVENT}")
            .selectExpr(
                "user_id % 10 AS index",
                "event_type",
                "event_id % 6 AS community",
                "CAST(ts AS date) AS snapshot_date",
                f"{cents('value')} AS cents",
            )
            .groupBy("index", "event_type", "community", "snapshot_date")
            .agg(F.expr("count(*) AS mention_count"), F.expr("sum(cents) AS score"))
        )
        return self._table(
            "social_buzz",
            daily.selectExpr(
                f"{category('index')} AS category_name",
                f"{KEYWORD} AS keyword",
                "concat('src', community) AS subreddit",
                "snapshot_date",
                "mention_count",
                f"{ratio('score', 'mention_count * 100', 2)} AS avg_score",
            ),
            schemas.SOCIAL_BUZZ,
        )

    @cached_property
    def consumer_spend(self) -> DataFrame:
        yearly = (
            self.table("orders")
            .selectExpr("o_custkey % 10 AS index", "year(o_orderdate) + 23 AS year", f"{cents('o_totalprice')} AS cents")
            .groupBy("index", "year")
            .agg(F.expr("sum(cents) AS cents"), F.expr("count(*) AS orders"))
            .selectExpr("index", "year", f"{ratio('cents', 'orders * 100', 2)} AS avg_annual_spend")
        )
        return self._table(
            "consumer_spend",
            yearly.selectExpr(
                f"{category('index')} AS category_name",
                f"{category('index')} AS bls_category",
                "year",
                "avg_annual_spend",
                f"{relative_change('avg_annual_spend', 'PARTITION BY index ORDER BY year')} AS yoy_change",
            ),
            schemas.CONSUMER_SPEND,
        )

    @cached_property
    def retail_vs_ecomm(self) -> DataFrame:
        online_of_ten = f"element_at(array({', '.join(map(str, ONLINE_OF_TEN))}), CAST(index AS int) + 1)"
        shares = (
            self.table("orders")
            .selectExpr(
                "o_custkey % 10 AS index",
                f"date_add(DATE'2024-01-01', int(({day_offset('o_orderdate')}) div 3 * 3)) AS period_date",
                "o_orderkey % 10 AS digit",
            )
            .groupBy("index", "period_date")
            .agg(F.expr(f"count_if(digit < {online_of_ten}) AS online"), F.expr("count(*) AS orders"))
            .selectExpr("index", "period_date", f"CAST({ratio('online', 'orders', 4)} AS decimal(5,4)) AS ecomm_share")
            .selectExpr("*", "1 - ecomm_share AS retail_share")
        )
        history = "PARTITION BY index ORDER BY period_date"
        return self._table(
            "retail_vs_ecomm",
            shares.selectExpr(
                f"{category('index')} AS category_name",
                "period_date",
                "ecomm_share",
                "retail_share",
                f"{relative_change('ecomm_share', history)} AS ecomm_growth",
                f"{relative_change('retail_share', history)} AS retail_growth",
                f"'{catalog.DERIVED}' AS source",
            ),
            schemas.RETAIL_VS_ECOMM,
        )

    @cached_property
    def score_inputs(self) -> DataFrame:
        return self._table(
            "score_inputs",
            score_inputs(self.category_trends, self.search_signals, self.social_buzz, self.consumer_spend, RUN_DATES),
        )

    @cached_property
    def niche_scores(self) -> DataFrame:
        return self._table("niche_scores", score_categories(self.score_inputs))


class RawFeeds(RawData):
    """Raw feeds in their landed shape, and dirty batches for the cleaning steps."""

    # Labels of the expenditure feed that map to a category; the other two pass through.
    SPEND_LABELS = {"1-URGENT": "Electronics", "2-HIGH": "Pet Supplies", "3-MEDIUM": "Collectibles"}

    def listing_pages(self) -> DataFrame:
        """One page per item; line 7 has no price and only returnflag N is on sale at a fixed price."""
        index = "l_partkey % 10"
        return self.table("lineitem").selectExpr(
            f"{category(index)} AS category_name",
            f"element_at({text_array(catalog.CATEGORY_IDS.values())}, CAST({index} AS int) + 1) AS category_id",
            "CAST(NULL AS bigint) AS total",
            "array(named_struct("
            "'price', CASE WHEN l_linenumber <> 7 THEN named_struct('value', CAST(l_extendedprice AS string)) END, "
            "'buyingOptions', CASE WHEN l_returnflag = 'N' THEN array('FIXED_PRICE') ELSE array('AUCTION') END"
            ")) AS itemSummaries",
        )

    def bestseller_items(self) -> DataFrame:
        return self.table("part").selectExpr(
            "concat('bestsellers_', p_brand) AS list_type", "p_retailprice AS price", "p_partkey"
        )

    @staticmethod
    def bestseller_order() -> list[Column]:
        return [F.col("price").desc(), F.col("p_partkey").asc()]

    @property
    def search_keywords(self) -> dict[str, str]:
        return {f"{c.lower()} {kind}": c for c in catalog.CATEGORIES for kind in ("view", "click")}

    def search_points(self) -> DataFrame:
        return (
            self.table("events")
            .where(SEARCH_EVENT)
            .selectExpr("user_id % 10 AS index", "event_type", "ts AS point_ts", "event_id", "value AS interest")
            .selectExpr(f"{KEYWORD} AS keyword", "point_ts", "event_id", "interest")
        )

    def posts(self) -> DataFrame:
        return (
            self.table("events")
            .where(f"NOT {SEARCH_EVENT}")
            .selectExpr(
                f"element_at({text_array(catalog.COMMUNITIES)}, CAST(event_id % 6 AS int) + 1) AS subreddit",
                f"element_at({text_array(catalog.COMMUNITY_TERMS.values())}, CAST(user_id % 10 AS int) + 1) AS keyword",
                "datediff(ts, DATE'1970-01-01') * 86400D AS created_utc",
                "ts",
                "event_id",
                "value AS score",
            )
        )

    def spend_rows(self) -> DataFrame:
        return (
            self.table("orders")
            .selectExpr("o_orderpriority", "year(o_orderdate) + 23 AS year", f"{cents('o_totalprice')} AS cents")
            .groupBy("o_orderpriority", "year")
            .agg(F.expr("sum(cents) AS cents"))
            .selectExpr(
                "concat(' ', o_orderpriority) AS category",
                "year",
                "cents / 100 AS avg_annual_expenditure",
                "coalesce(lag(cents) OVER (PARTITION BY o_orderpriority ORDER BY year), 0) / 100 AS prev_year_expenditure",
            )
        )

    def bestseller_lists(self) -> DataFrame:
        """The lists as arrays, each in its order."""
        entry = "struct(-p_retailprice AS place, p_partkey, struct(p_retailprice AS value) AS price)"
        lists = self.table("part").groupBy("p_brand").agg(F.expr(f"sort_array(collect_list({entry})) AS entries"))
        return lists.selectExpr(
            "concat('bestsellers_', p_brand) AS list_type", "transform(entries, e -> struct(e.price AS price)) AS bestsellers"
        )

    def damaged_listing_batch(self) -> DataFrame:
        """The batch with days in other spellings, and rows without a category, a day or a readable one."""
        spelled = (
            "CASE WHEN l_linenumber = 6 AND l_partkey % 5 = 0 THEN 'June' WHEN l_linenumber = 4 AND l_partkey % 7 = 0 THEN NULL "
            "WHEN l_linenumber = 2 THEN date_format(CAST(snapshot_date AS date), 'MMM d, yyyy') "
            "WHEN l_linenumber = 1 THEN date_format(CAST(snapshot_date AS date), 'M/d/yyyy') ELSE snapshot_date END"
        )
        return self.listing_batch().withColumns(
            {
                "category_name": F.expr("CASE WHEN l_linenumber <> 5 OR l_partkey % 3 <> 0 THEN category_name END"),
                "snapshot_date": F.expr(spelled),
            }
        )

    def item_lines(self) -> str:
        """A folder of items as lines of JSON, every 150th cut short."""
        line = "to_json(struct(p_partkey, p_name, named_struct('value', p_retailprice) AS price))"
        path = f"{shared_folder(self.spark)}/lines-{uuid.uuid4().hex}"
        whole = f"CASE WHEN p_partkey % 150 = 0 THEN substring({line}, 1, 25) ELSE {line} END AS value"
        self.table("part").selectExpr(whole).write.text(path)
        return path

    # Dirty batches: padded and mis-cased names, numbers as text, values out of range, repeated keys.

    @staticmethod
    def _untidy(index: str, flag: str) -> str:
        name = category(index)
        return (
            f"CASE {flag} % 3 WHEN 0 THEN concat('  ', upper({name})) WHEN 1 THEN concat(lower({name}), '\\t ') ELSE {name} END"
        )

    LISTING_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

    def arrived(self, name: str) -> DataFrame:
        return with_arrival(self.table(name))

    def listing_batch(self) -> DataFrame:
        return self.arrived("lineitem").selectExpr(
            ARRIVAL,
            *self.LISTING_ORDER,
            f"{self._untidy('l_partkey % 10', 'l_linenumber')} AS category_name",
            "CAST(l_partkey AS string) AS category_id",
            f"{SOURCE} AS source",
            f"CAST({folded_day('l_shipdate')} AS string) AS snapshot_date",
            "CASE WHEN l_linenumber = 3 THEN 'many' ELSE CAST(l_quantity AS string) END AS listing_count",
            "CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_extendedprice / 1000 AS string) END AS avg_price",
            "CASE WHEN l_linenumber <> 5 THEN l_quantity / 4 END AS sold_count",
            "CAST(l_discount * 15 - 0.1D AS string) AS sell_through",
            "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS string) END AS rank_position",
        )

    def search_batch(self) -> DataFrame:
        return self.arrived("events").where(SEARCH_EVENT).selectExpr(
            ARRIVAL,
            f"concat('  ', initcap(concat_ws(' ', {category('user_id % 10')}, event_type)), ' ') AS keyword",
            f"{self._untidy('user_id % 10', 'event_id')} AS category_name",
            "CAST(CAST(ts AS date) AS string) AS snapshot_date",
            "CASE WHEN event_id % 11 = 0 THEN 'unknown' ELSE CAST(value - 5 AS string) END AS interest_score",
            "CASE user_id % 7 WHEN 0 THEN 'ca' WHEN 1 THEN NULL ELSE 'us' END AS geo",
        )

    def social_batch(self) -> DataFrame:
        return self.arrived("events").where(f"NOT {SEARCH_EVENT}").selectExpr(
            ARRIVAL,
            f"{self._untidy('user_id % 10', 'event_id')} AS category_name",
            f"upper(concat_ws(' ', {category('user_id % 10')}, event_type)) AS keyword",
            "concat(' Src', event_id % 6, '\\n') AS subreddit",
            "CAST(CAST(ts AS date) AS string) AS snapshot_date",
            "CASE WHEN event_id % 13 = 0 THEN '?' ELSE CAST(value / 2 AS string) END AS mention_count",
            "CASE WHEN event_id % 5 <> 0 THEN CAST(value / 7 AS string) END AS avg_score",
        )

    def spend_batch(self) -> DataFrame:
        """Years spread over 1995 .. 2018, so some are dropped as too old."""
        return self.arrived("orders").selectExpr(
            ARRIVAL,
            f"{self._untidy('o_custkey % 10', 'o_orderkey')} AS category_name",
            "o_orderpriority AS bls_category",
            "CASE WHEN o_orderkey % 17 = 0 THEN 'year?' ELSE CAST(year(o_orderdate) + o_orderkey % 18 AS string) END AS year",
            "CAST(o_totalprice / 3 AS string) AS avg_annual_spend",
            "CASE WHEN o_orderkey % 19 = 0 THEN '-' ELSE CAST(o_totalprice / 1000000 - 0.2D AS string) END AS yoy_change",
        )
