"""Independent SQL for every query, written for DuckDB over the same given tables.

Signal tables are CTEs that hold whole numbers (cents, 1/10000 shares, 1/100 scores), so that each
rounding is integer arithmetic and does not depend on how an engine rounds binary fractions. Scoring
uses doubles and half-even rounding, as the job does.
"""

from datetime import date

from tradewind import catalog
from tradewind.testbed.mapping import AS_OF, ONLINE_OF_TEN, RUN_DATES, RawFeeds

D = f"DATE '{AS_OF}'"
# --- an earlier day that is asked for later ---
PAST_RUN = date(2024, 1, 26)


def text_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator in units of 10^-digits, halves away from zero (denominator > 0)."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"(sign({n}) * ((2 * {10**digits} * abs({n}) + {d}) // (2 * {d})))"


def units(expression: str, digits: int) -> str:
    return f"CAST({expression} AS DOUBLE) / {10**digits}"


def binary_round(expression: str, digits: int) -> str:
    return f"round_even(({expression}) * CAST({10**digits} AS DOUBLE), 0) / CAST({10**digits} AS DOUBLE)"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


CATEGORY = text_list(catalog.CATEGORIES)


def category(index: str) -> str:
    return f"list_extract({CATEGORY}, CAST({index} AS INTEGER) + 1)"


def offset(moment: str) -> str:
    return f"(CAST({moment} AS DATE) - DATE '1995-01-01') % 30"


def day(moment: str) -> str:
    return f"(DATE '2024-01-01' + CAST({offset(moment)} AS INTEGER))"


def cents(money: str) -> str:
    return f"CAST(round({money} * 100) AS BIGINT)"


SOURCE = "CASE WHEN l_suppkey % 4 = 0 THEN 'amazon_bsr' ELSE 'ebay' END"

TRENDS = f"""trends AS (
  SELECT {category('l_partkey % 10')} AS category_name, CAST(l_partkey % 10 AS VARCHAR) AS category_id,
    {SOURCE} AS source, {day('l_shipdate')} AS snapshot_date,
    count(*) AS listing_count,
    {half_up(f"sum({cents('l_extendedprice')})", 'sum(CAST(l_quantity AS BIGINT)) * 25', 0)} AS price2,
    count(*) FILTER (l_returnflag = 'N') AS sold_count,
    {half_up("count(*) FILTER (l_returnflag = 'N')", 'count(*)', 4)} AS st4
  FROM lineitem GROUP BY ALL)"""

SEARCH = f"""search AS (
  SELECT lower({category('user_id % 10')}) || ' ' || event_type AS keyword,
    {category('user_id % 10')} AS category_name, CAST(ts AS DATE) AS snapshot_date,
    CAST(least(100, floor(max(value) / 5)) AS BIGINT) AS interest_score,
    CASE WHEN user_id % 7 = 0 THEN 'CA' ELSE 'US' END AS geo
  FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL)"""

SOCIAL = f"""social AS (
  SELECT {category('user_id % 10')} AS category_name,
    lower({category('user_id % 10')}) || ' ' || event_type AS keyword,
    'src' || CAST(event_id % 6 AS VARCHAR) AS subreddit, CAST(ts AS DATE) AS snapshot_date,
    count(*) AS mention_count, {half_up(f"sum({cents('value')})", 'count(*)', 0)} AS score2
  FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY ALL)"""


def change4(value: str, before: str) -> str:
    return f"CASE WHEN {before} <> 0 THEN {half_up(f'{value} - {before}', before, 4)} END"


SPEND = f"""spend0 AS (
  SELECT {category('o_custkey % 10')} AS category_name, {category('o_custkey % 10')} AS bls_category,
    CAST(year(o_orderdate) + 23 AS INTEGER) AS year,
    {half_up(f"sum({cents('o_totalprice')})", 'count(*)', 0)} AS spend2
  FROM orders GROUP BY ALL),
spend1 AS (SELECT *, lag(spend2) OVER (PARTITION BY category_name ORDER BY year) AS before FROM spend0),
spend AS (SELECT category_name, bls_category, year, spend2, {change4('spend2', 'before')} AS yoy4 FROM spend1)"""

ONLINE = f"list_extract({ONLINE_OF_TEN}, CAST(o_custkey % 10 AS INTEGER) + 1)"

CHANNELS = f"""channels0 AS (
  SELECT {category('o_custkey % 10')} AS category_name,
    (DATE '2024-01-01' + CAST(({offset('o_orderdate')}) // 3 * 3 AS INTEGER)) AS period_date,
    {half_up(f'count(*) FILTER (o_orderkey % 10 < {ONLINE})', 'count(*)', 4)} AS share4
  FROM orders GROUP BY ALL),
channels1 AS (
  SELECT *, 10000 - share4 AS retail4,
    lag(share4) OVER (PARTITION BY category_name ORDER BY period_date) AS before,
    10000 - lag(share4) OVER (PARTITION BY category_name ORDER BY period_date) AS retail_before
  FROM channels0),
channels AS (
  SELECT category_name, period_date, share4, retail4, {change4('share4', 'before')} AS growth4,
    {change4('retail4', 'retail_before')} AS retail_growth4, 'derived' AS source
  FROM channels1)"""


def run_list(dates) -> str:
    return "runs AS (SELECT unnest([" + ", ".join(f"DATE '{d}'" for d in dates) + "]) AS as_of)"


INPUTS = """interest_day AS (
  SELECT category_name, snapshot_date,
    coalesce(CAST(sum(interest_score) AS DOUBLE) / count(interest_score), 0) AS interest
  FROM search GROUP BY ALL),
interest_run AS (
  SELECT as_of, category_name, arg_max(interest, snapshot_date) AS interest, min(interest) AS low, max(interest) AS high
  FROM runs JOIN interest_day ON snapshot_date BETWEEN as_of - 30 AND as_of GROUP BY ALL),
buzz_run AS (
  SELECT as_of, category_name, sum(mention_count) AS mentions
  FROM runs JOIN social ON snapshot_date BETWEEN as_of - 7 AND as_of GROUP BY ALL),
demand_run AS (
  SELECT as_of, category_name, CAST(sum(st4) AS DOUBLE) / 10000 / count(st4) AS sell_through,
    CAST(sum(listing_count) AS DOUBLE) / count(listing_count) AS listings
  FROM runs JOIN trends ON snapshot_date = as_of GROUP BY ALL),
spend_run AS (
  SELECT as_of, category_name, CAST(sum(yoy4) AS DOUBLE) / 10000 / count(yoy4) AS growth
  FROM runs JOIN spend ON year BETWEEN year(as_of) - 2 AND year(as_of) GROUP BY ALL),
inputs AS (
  SELECT as_of, category_name, coalesce(interest, 0) AS raw_trend, coalesce(low, 0) AS trend_low,
    coalesce(high, 0) AS trend_high, CAST(coalesce(mentions, 0) AS DOUBLE) AS raw_buzz,
    coalesce(sell_through, 0) * CAST(100 AS DOUBLE) AS raw_demand, coalesce(growth, 0) * CAST(100 AS DOUBLE) AS raw_spend,
    coalesce(listings, 0) AS avg_listings,
    CAST(1 AS DOUBLE) / (coalesce(listings, 0) + 1) * CAST(10000 AS DOUBLE) AS raw_competition
  FROM demand_run LEFT JOIN interest_run USING (as_of, category_name)
    LEFT JOIN buzz_run USING (as_of, category_name) LEFT JOIN spend_run USING (as_of, category_name))"""


def scaled(value: str, low: str, high: str) -> str:
    bottom, top = f"min({low}) OVER (PARTITION BY as_of)", f"max({high}) OVER (PARTITION BY as_of)"
    ratio = f"({value} - {bottom}) / nullif({top} - {bottom}, 0) * CAST(100 AS DOUBLE)"
    return f"CASE WHEN {bottom} = {top} THEN CAST(50 AS DOUBLE) ELSE {binary_round(ratio, 2)} END"


SCORES = f"""components AS (
  SELECT as_of, category_name, {scaled('raw_trend', 'trend_low', 'trend_high')} AS trend_score,
    {scaled('raw_buzz', 'raw_buzz', 'raw_buzz')} AS buzz_score,
    {scaled('raw_demand', 'raw_demand', 'raw_demand')} AS demand_score,
    {scaled('raw_spend', 'raw_spend', 'raw_spend')} AS spend_score,
    {scaled('raw_competition', 'raw_competition', 'raw_competition')} AS competition_score
  FROM inputs),
scored AS (
  SELECT *, {binary_round('(((trend_score * CAST(0.25 AS DOUBLE) + buzz_score * CAST(0.20 AS DOUBLE)) + demand_score * CAST(0.30 AS DOUBLE)) + spend_score * CAST(0.15 AS DOUBLE)) + competition_score * CAST(0.10 AS DOUBLE)', 2)} AS opportunity_score
  FROM components),
scores AS (
  SELECT category_name, as_of AS scored_at, trend_score, buzz_score, demand_score, spend_score, competition_score,
    opportunity_score, CAST(round(opportunity_score * 100) AS BIGINT) AS opp2,
    CASE WHEN demand_score > 60 THEN 'ecomm' WHEN demand_score < 35 THEN 'retail' ELSE 'mixed' END AS channel_edge,
    CASE WHEN opportunity_score >= 65 THEN 'enter' WHEN opportunity_score >= 40 THEN 'watch' ELSE 'avoid' END AS recommendation
  FROM scored)"""

SCORE_COLUMNS = (
    "trend_score, buzz_score, demand_score, spend_score, competition_score, opportunity_score, "
    "channel_edge, recommendation"
)
RUNS = run_list(RUN_DATES)
SIGNALS = [TRENDS, SEARCH, SOCIAL, SPEND]
SCORING = [*SIGNALS, RUNS, INPUTS, SCORES]


def sql(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- read models ---

LEADERBOARD = f"""latest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY scored_at DESC) = 1),
previous AS (
  SELECT category_name, opp2 AS previous2 FROM scores WHERE scored_at < (SELECT max(scored_at) FROM scores)
  QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY scored_at DESC) = 1),
listing AS (
  SELECT * FROM trends
  QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY snapshot_date DESC, source DESC) = 1),
leaderboard AS (
  SELECT category_name, opportunity_score, trend_score, buzz_score, demand_score, spend_score, competition_score,
    channel_edge, recommendation, scored_at, opp2, opp2 - coalesce(previous2, opp2) AS delta2,
    {units('opp2 - coalesce(previous2, opp2)', 2)} AS score_delta,
    CAST(rank() OVER (ORDER BY opp2 DESC) AS INTEGER) AS current_rank, {units('st4', 4)} AS sell_through,
    {units('price2', 2)} AS avg_price, listing_count,
    CASE WHEN opp2 - coalesce(previous2, opp2) > 500 THEN 'Rising'
      WHEN opp2 - coalesce(previous2, opp2) < -500 THEN 'Declining' ELSE 'Stable' END AS momentum
  FROM latest LEFT JOIN previous USING (category_name) LEFT JOIN listing USING (category_name))"""

COMPARISON = f"""comparison AS (
  SELECT category_name, period_date, {half_up('share4', '100', 1)} AS share1, {half_up('retail4', '100', 1)} AS retail1,
    growth4, retail_growth4,
    CASE WHEN share4 > 5500 THEN 'E-comm dominant' WHEN share4 < 3000 THEN 'Retail dominant' ELSE 'Contested' END AS channel_status,
    CASE WHEN growth4 > 500 AND share4 < 4500 THEN 'Early mover opportunity'
      WHEN growth4 > 500 AND share4 >= 4500 THEN 'Growing — competitive'
      WHEN growth4 < 0 THEN 'E-comm contracting' ELSE 'Stable' END AS opportunity_label
  FROM channels)"""
COMPARISON_OUT = f"""category_name, period_date, {units('share1', 1)} AS ecomm_share_pct, {units('retail1', 1)} AS retail_share_pct,
  {units('growth4', 2)} AS ecomm_growth_pct, {units('retail_growth4', 2)} AS retail_growth_pct, channel_status, opportunity_label"""

SUMMARY = f"""summary AS (
  SELECT category_name, {units(half_up('sum(share1)', 'count(share1)', 0), 1)} AS avg_ecomm_share,
    {units(half_up('sum(retail1)', 'count(retail1)', 0), 1)} AS avg_retail_share,
    {units(half_up('sum(growth4)', 'count(growth4)', 0), 2)} AS avg_ecomm_growth,
    max(channel_status) AS channel_status, max(opportunity_label) AS opportunity_label
  FROM comparison GROUP BY category_name)"""

NICHES = f"""latest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY scored_at DESC) = 1),
demand AS (
  SELECT category_name, {units('price2', 2)} AS avg_price, listing_count, {units('st4', 2)} AS sell_through_pct
  FROM trends WHERE source = 'ebay'
  QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY snapshot_date DESC) = 1),
interest AS (
  SELECT category_name, {units(half_up('sum(interest_score)', 'count(interest_score)', 1), 1)} AS avg_interest_30d
  FROM search WHERE geo = 'US' AND snapshot_date BETWEEN {D} - 30 AND {D} GROUP BY category_name),
buzz AS (
  SELECT category_name, {whole('sum(mention_count)')} AS weekly_mentions, count(DISTINCT subreddit) AS subreddit_count
  FROM social WHERE snapshot_date BETWEEN {D} - 7 AND {D} GROUP BY category_name),
expenses AS (
  SELECT category_name, {units('spend2', 2)} AS avg_annual_spend, {units('yoy4', 2)} AS spend_growth_pct
  FROM spend QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY year DESC) = 1),
niches AS (
  SELECT category_name, {SCORE_COLUMNS}, scored_at, avg_price, listing_count, sell_through_pct, avg_interest_30d,
    weekly_mentions, subreddit_count, avg_annual_spend, spend_growth_pct
  FROM latest LEFT JOIN demand USING (category_name) LEFT JOIN interest USING (category_name)
    LEFT JOIN buzz USING (category_name) LEFT JOIN expenses USING (category_name))"""

EXPLORER = f"""explorer AS (
  SELECT t.category_name, t.snapshot_date, {units('st4', 2)} AS sell_through_pct, {units('price2', 2)} AS avg_price,
    listing_count, sold_count, coalesce(i.interest, 0) AS search_interest, coalesce(m.mentions, 0) AS reddit_mentions, t.source
  FROM trends t
  LEFT JOIN (SELECT category_name, snapshot_date,
      {units(half_up('sum(interest_score)', 'count(interest_score)', 1), 1)} AS interest
    FROM search WHERE geo = 'US' GROUP BY ALL) i
    ON i.category_name = t.category_name AND i.snapshot_date = t.snapshot_date
  LEFT JOIN (SELECT category_name, snapshot_date, {whole('sum(mention_count)')} AS mentions FROM social GROUP BY ALL) m
    ON m.category_name = t.category_name AND m.snapshot_date = t.snapshot_date)"""

BOARD = [*SCORING, LEADERBOARD]
NICHE = [*SCORING, NICHES]
EXPLORE = [TRENDS, SEARCH, SOCIAL, EXPLORER]
COMPARE = [CHANNELS, COMPARISON]

BOARD_COLUMNS = (
    f"category_name, {SCORE_COLUMNS}, scored_at, score_delta, current_rank, sell_through, avg_price, listing_count, momentum"
)
NICHE_READ = (
    f"category_name, {SCORE_COLUMNS}, avg_price, sell_through_pct, avg_interest_30d, weekly_mentions, spend_growth_pct, listing_count"
)

# --- raw feeds ---

LISTING_FEED = f"""page AS (
  SELECT {category('l_partkey % 10')} AS category_name,
    list_extract({text_list(catalog.CATEGORY_IDS.values())}, CAST(l_partkey % 10 AS INTEGER) + 1) AS category_id,
    CASE WHEN l_linenumber <> 7 THEN {cents('l_extendedprice')} END AS price, l_returnflag = 'N' AS fixed
  FROM lineitem),
listings AS (
  SELECT category_name, category_id, 'ebay' AS source, {D} AS snapshot_date, count(*) AS listing_count,
    {half_up('sum(price)', 'count(price)', 0)} AS price2, count(*) FILTER (fixed) AS sold_count,
    {half_up('count(*) FILTER (fixed)', 'count(*)', 4)} AS st4
  FROM page GROUP BY ALL)"""

RANKED_FEED = f"""ranked AS (
  SELECT p_brand AS category_name, 'bestsellers_' || p_brand AS category_id, 'amazon_bsr' AS source, {D} AS snapshot_date,
    p_retailprice AS price,
    row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place
  FROM part)"""

SEARCH_FEED = f"""points AS (
  SELECT lower({category('user_id % 10')}) || ' ' || event_type AS keyword, {category('user_id % 10')} AS category_name,
    CAST(trunc(value) AS BIGINT) AS interest_score
  FROM events WHERE event_type IN ('view', 'click') AND CAST(ts AS DATE) BETWEEN {D} - INTERVAL 3 MONTH AND {D}
  QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY ts DESC, event_id DESC) = 1)"""

POST_FEED = f"""post AS (
  SELECT list_extract({text_list(catalog.COMMUNITIES)}, CAST(event_id % 6 AS INTEGER) + 1) AS subreddit,
    list_extract({text_list(catalog.COMMUNITY_TERMS.values())}, CAST(user_id % 10 AS INTEGER) + 1) AS keyword,
    CAST(ts AS DATE) AS posted, {cents('value')} AS score
  FROM events WHERE event_type NOT IN ('view', 'click')),
recent AS (
  SELECT subreddit, keyword, count(*) AS mention_count, {half_up('sum(score)', 'count(score)', 0)} AS score2
  FROM post WHERE posted BETWEEN {D} - 7 AND {D} GROUP BY ALL),
grid AS (
  SELECT unnest({text_list(catalog.COMMUNITIES)}) AS subreddit, category_name, keyword
  FROM (SELECT unnest({CATEGORY}) AS category_name, unnest({text_list(catalog.COMMUNITY_TERMS.values())}) AS keyword)),
posts AS (
  SELECT category_name, keyword, subreddit, {D} AS snapshot_date, coalesce(mention_count, 0) AS mention_count,
    coalesce(score2, 0) AS score2
  FROM grid LEFT JOIN recent USING (subreddit, keyword))"""

_LABEL = "CASE o_orderpriority " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in RawFeeds.SPEND_LABELS.items()
) + " ELSE o_orderpriority END"
SPEND_FEED = f"""spend_year AS (
  SELECT o_orderpriority, CAST(year(o_orderdate) + 23 AS INTEGER) AS year, CAST(sum({cents('o_totalprice')}) AS BIGINT) AS spend2
  FROM orders GROUP BY ALL),
spend_before AS (SELECT *, coalesce(lag(spend2) OVER (PARTITION BY o_orderpriority ORDER BY year), 0) AS before FROM spend_year),
expenditure AS (
  SELECT {_LABEL} AS category_name, o_orderpriority AS bls_category, year, spend2, {change4('spend2', 'before')} AS yoy4
  FROM spend_before)"""


def title(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, '[A-Za-z]+|[^A-Za-z]+'), "
        "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '')"
    )


# --- cleaning ---

LISTING_BATCH = f"""cleaned AS (
  SELECT {category('l_partkey % 10')} AS category_name, CAST(l_partkey AS VARCHAR) AS category_id, {SOURCE} AS source,
    {day('l_shipdate')} AS snapshot_date,
    CASE WHEN l_linenumber = 3 THEN 0 ELSE CAST(trunc(l_quantity) AS BIGINT) END AS listing_count,
    CASE WHEN l_linenumber <> 7 THEN {binary_round('l_extendedprice / 1000', 2)} END AS avg_price,
    CASE WHEN l_linenumber = 5 THEN 0 ELSE CAST(trunc(l_quantity / 4) AS BIGINT) END AS sold_count,
    {binary_round('greatest(least(l_discount * 15 - 0.1, 1), 0)', 4)} AS sell_through,
    CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END AS rank_position
  FROM arrived
  QUALIFY row_number() OVER (PARTITION BY l_partkey % 10, source, snapshot_date ORDER BY place) = 1)"""


def arrived(table: str, first: str = "") -> str:
    """A table with the place of each row in its file, or in a stated order."""
    return f"arrived AS (SELECT *, row_number() OVER ({first}) AS place FROM {table})"


LISTING_ORDER = f"ORDER BY {', '.join(RawFeeds.LISTING_ORDER)}"
NO_CATEGORY = "l_linenumber = 5 AND l_partkey % 3 = 0"
NO_DAY = "l_linenumber = 4 AND l_partkey % 7 = 0"
ODD_DAY = "l_linenumber = 6 AND l_partkey % 5 = 0"


def load_sql(ctes, table, columns, column, cut, overlap, changed, amount) -> str:
    """Rows up to the cut, with everything from the overlap on replaced by its changed version."""

    def listed(change: bool) -> str:
        return ", ".join(f"{c} + {amount} AS {c}" if change and c == changed else c for c in columns)

    return sql(
        [*ctes, f"shown AS (SELECT {', '.join(columns)} FROM {table})"],
        f"SELECT {listed(False)} FROM shown WHERE {column} <= {cut} AND {column} < {overlap} "
        f"UNION ALL SELECT {listed(True)} FROM shown WHERE {column} >= {overlap}",
    )


def build_oracle() -> dict[str, str]:
    trends_out = (
        f"category_name, category_id, source, snapshot_date, listing_count, {units('price2', 2)} AS avg_price, "
        f"sold_count, {units('st4', 4)} AS sell_through, CAST(NULL AS INTEGER) AS rank_position"
    )
    search_out = "keyword, category_name, snapshot_date, CAST(interest_score AS INTEGER) AS interest_score, geo"
    social_out = f"category_name, keyword, subreddit, snapshot_date, mention_count, {units('score2', 2)} AS avg_score"
    spend_out = f"category_name, bls_category, year, {units('spend2', 2)} AS avg_annual_spend, {units('yoy4', 4)} AS yoy_change"
    channels_out = (
        f"category_name, period_date, {units('share4', 4)} AS ecomm_share, {units('retail4', 4)} AS retail_share, "
        f"{units('growth4', 4)} AS ecomm_growth, {units('retail_growth4', 4)} AS retail_growth, source"
    )
    scores_out = (
        "category_name, scored_at, trend_score, buzz_score, demand_score, spend_score, competition_score, "
        "opportunity_score, channel_edge, recommendation"
    )
    typed = {
        "trends": f"trends_out AS (SELECT {trends_out} FROM trends)",
        "search": f"search_out AS (SELECT {search_out} FROM search)",
        "social": f"social_out AS (SELECT {social_out} FROM social)",
        "spend": f"spend_out AS (SELECT {spend_out} FROM spend)",
        "channels": f"channels_out AS (SELECT {channels_out} FROM channels)",
    }
    trend_columns = (
        "category_name category_id source snapshot_date listing_count avg_price sold_count sell_through rank_position"
    ).split()
    sizes = [
        ("category_trends", "trends"),
        ("retail_vs_ecomm", "channels"),
        ("search_signals", "search"),
        ("social_buzz", "social"),
        ("consumer_spend", "spend"),
        ("niche_scores", "scores"),
    ]
    everything = [*SCORING, CHANNELS]

    q: dict[str, str] = {}
    q["category_trends"] = sql([TRENDS], f"SELECT {trends_out} FROM trends")
    q["search_signals"] = sql([SEARCH], f"SELECT {search_out} FROM search")
    q["social_buzz"] = sql([SOCIAL], f"SELECT {social_out} FROM social")
    q["consumer_spend"] = sql([SPEND], f"SELECT {spend_out} FROM spend")
    q["retail_vs_ecomm"] = sql([CHANNELS], f"SELECT {channels_out} FROM channels")

    q["src_listings"] = sql([LISTING_FEED], f"SELECT {trends_out} FROM listings")
    q["src_bestsellers"] = sql(
        [RANKED_FEED],
        "SELECT category_name, category_id, source, snapshot_date, CAST(NULL AS BIGINT) AS listing_count, price AS avg_price, "
        "CAST(NULL AS BIGINT) AS sold_count, CAST(NULL AS DOUBLE) AS sell_through, CAST(place AS INTEGER) AS rank_position "
        "FROM ranked",
    )
    q["src_bestsellers_lists"] = q["src_bestsellers"]
    q["latest_list_entries"] = q["src_bestsellers"] + " WHERE place <= 50"
    q["src_search_interest"] = sql(
        [SEARCH_FEED],
        f"SELECT keyword, category_name, {D} AS snapshot_date, CAST(interest_score AS INTEGER) AS interest_score, "
        "'US' AS geo FROM points",
    )
    q["src_social_posts"] = sql([POST_FEED], f"SELECT {social_out} FROM posts")
    q["src_spend_csv"] = sql([SPEND_FEED], f"SELECT {spend_out} FROM expenditure")
    q["read_table"] = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"
    )

    day_of = "DATE '2024-01-{:02d}'".format
    q["upsert"] = load_sql(
        [TRENDS, typed["trends"]], "trends_out", trend_columns, "snapshot_date", day_of(20), day_of(15), "sold_count", 1
    )
    q["upsert_partial"] = sql(
        [TRENDS, typed["trends"]],
        f"""SELECT category_name, CASE WHEN snapshot_date <= {day_of(20)} THEN category_id END AS category_id, source,
  snapshot_date, listing_count, CASE WHEN snapshot_date <= {day_of(20)} THEN avg_price END AS avg_price,
  CASE WHEN snapshot_date >= {day_of(15)} THEN sold_count + 1 ELSE sold_count END AS sold_count, sell_through, rank_position
FROM trends_out""",
    )
    q["load_category_trends"] = load_sql(
        [TRENDS, typed["trends"]], "trends_out", trend_columns, "snapshot_date", day_of(10), day_of(9), "listing_count", 7
    )
    q["load_search_signals"] = load_sql(
        [SEARCH, typed["search"]], "search_out", "keyword category_name snapshot_date interest_score geo".split(),
        "snapshot_date", day_of(20), day_of(15), "interest_score", 1,
    )
    q["load_social_buzz"] = load_sql(
        [SOCIAL, typed["social"]], "social_out",
        "category_name keyword subreddit snapshot_date mention_count avg_score".split(),
        "snapshot_date", day_of(20), day_of(15), "mention_count", 3,
    )
    spend_plus = "year >= 2021"
    q["load_consumer_spend"] = sql(
        [SPEND],
        f"SELECT category_name, bls_category, year, {units(f'spend2 + CASE WHEN {spend_plus} THEN 100 ELSE 0 END', 2)} AS avg_annual_spend, "
        f"{units('yoy4', 4)} AS yoy_change FROM spend",
    )
    q["load_retail_vs_ecomm"] = sql(
        [CHANNELS],
        f"SELECT category_name, period_date, {units('share4', 4)} AS ecomm_share, {units('retail4', 4)} AS retail_share, "
        f"{units('growth4', 4)} AS ecomm_growth, "
        f"{units(f'retail_growth4 + CASE WHEN period_date >= {day_of(13)} THEN 10000 ELSE 0 END', 4)} AS retail_growth, source FROM channels",
    )
    q["load_niche_scores"] = sql(
        SCORING,
        "SELECT category_name, scored_at, trend_score, buzz_score, demand_score, spend_score, competition_score, "
        f"{units(f'opp2 + CASE WHEN scored_at >= {day_of(24)} THEN 100 ELSE 0 END', 2)} AS opportunity_score, "
        "channel_edge, recommendation FROM scores",
    )
    q["load_tables_twice"] = sql(
        everything,
        " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}" for name, cte in sizes),
    )
    q["reset_tables"] = sql(
        [TRENDS],
        f"SELECT unnest({text_list(n for n, _ in sizes)}) AS table_name, CAST(0 AS BIGINT) AS row_count, "
        "(SELECT count(*) FROM trends) AS trend_rows_before",
    )
    q["refresh_views"] = sql(
        everything,
        """SELECT view_name, 'refreshed' AS outcome, row_count FROM (
  SELECT 'mv_category_leaderboard' AS view_name, count(DISTINCT category_name) AS row_count FROM scores
  UNION ALL SELECT 'mv_channel_comparison', count(*) FROM channels
  UNION ALL SELECT 'mv_niche_finder', count(DISTINCT category_name) FROM scores
  UNION ALL SELECT 'mv_trends_explorer', count(*) FROM trends)""",
    )

    messy = "upper(p_name) || '''s 3d-' || p_type || ' & ' || p_brand"
    q["normalize_category"] = f"SELECT p_partkey, {title(messy)} AS category_name FROM part"
    q["clip_score"] = (
        "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN least(greatest(value - 20, 0), 100) END AS score FROM events"
    )
    cleaned = f"SELECT {', '.join(trend_columns)} FROM cleaned"
    q["clean_category_trends"] = sql([arrived("lineitem"), LISTING_BATCH], cleaned)
    q["union_sources"] = sql([arrived("lineitem", LISTING_ORDER), LISTING_BATCH], cleaned)
    readable = f"usable AS (SELECT * FROM arrived WHERE NOT (({NO_CATEGORY}) OR ({NO_DAY}) OR ({ODD_DAY})))"
    q["clean_split_listings"] = sql([arrived("lineitem"), readable, LISTING_BATCH.replace("FROM arrived", "FROM usable")], cleaned)
    q["rejected_listings"] = f"""SELECT CASE WHEN {NO_CATEGORY} THEN 'no category_name' WHEN {NO_DAY} THEN 'no snapshot_date'
  ELSE 'unreadable snapshot_date' END AS reason, count(*) AS rejected
FROM lineitem WHERE ({NO_CATEGORY}) OR ({NO_DAY}) OR ({ODD_DAY}) GROUP BY ALL"""
    q["land_json_feed"] = """SELECT p_partkey, p_name, p_retailprice AS price,
  (SELECT count(*) FROM part WHERE p_partkey % 150 = 0) AS damaged_lines
FROM part WHERE p_partkey % 150 <> 0"""
    q["clean_search_signals"] = f"""WITH {arrived('events')}
SELECT lower({category('user_id % 10')}) || ' ' || event_type AS keyword,
  {category('user_id % 10')} AS category_name, CAST(ts AS DATE) AS snapshot_date,
  CASE WHEN event_id % 11 = 0 THEN 0 ELSE CAST(least(greatest(trunc(value - 5), 0), 100) AS INTEGER) END AS interest_score,
  CASE WHEN user_id % 7 = 0 THEN 'CA' ELSE 'US' END AS geo
FROM arrived WHERE event_type IN ('view', 'click')
QUALIFY row_number() OVER (PARTITION BY keyword, snapshot_date, geo ORDER BY place) = 1"""
    q["clean_social_buzz"] = f"""WITH {arrived('events')}
SELECT {category('user_id % 10')} AS category_name,
  lower({category('user_id % 10')}) || ' ' || event_type AS keyword, 'Src' || CAST(event_id % 6 AS VARCHAR) AS subreddit,
  CAST(ts AS DATE) AS snapshot_date,
  CASE WHEN event_id % 13 = 0 THEN 0 ELSE CAST(trunc(value / 2) AS BIGINT) END AS mention_count,
  CASE WHEN event_id % 5 = 0 THEN 0 ELSE {binary_round('value / 7', 2)} END AS avg_score
FROM arrived WHERE event_type NOT IN ('view', 'click')
QUALIFY row_number() OVER (PARTITION BY keyword, subreddit, snapshot_date ORDER BY place) = 1"""
    q["clean_consumer_spend"] = f"""WITH {arrived('orders')}
SELECT {category('o_custkey % 10')} AS category_name, o_orderpriority AS bls_category,
  CAST(year(o_orderdate) + o_orderkey % 18 AS INTEGER) AS year, {binary_round('o_totalprice / 3', 2)} AS avg_annual_spend,
  CASE WHEN o_orderkey % 19 <> 0 THEN {binary_round('o_totalprice / 1000000 - 0.2', 4)} END AS yoy_change
FROM arrived WHERE o_orderkey % 17 <> 0 AND year(o_orderdate) + o_orderkey % 18 > 2000
QUALIFY row_number() OVER (PARTITION BY o_custkey % 10, year(o_orderdate) + o_orderkey % 18 ORDER BY place) = 1"""
    base = ", ".join(
        f"('{c}', {round(float(share) * 100)})" for c, share in catalog.BASE_ONLINE_SHARE.items()
    )
    share = half_up("base2 * 100000 * n + change4 * 135", "1000 * n", 0)
    rest = half_up("(100 - base2) * 100000 * n - change4 * 135", "1000 * n", 0)
    over = "base2 * 100000 * n + change4 * 135 > 9500 * 1000 * n"
    q["build_retail_vs_ecomm"] = sql(
        [
            SPEND,
            f"base(category_name, base2) AS (VALUES {base})",
            "yearly AS (SELECT category_name, sum(yoy4) AS change4, count(yoy4) AS n FROM spend GROUP BY category_name)",
            "joined AS (SELECT category_name, base2, coalesce(change4, 0) AS change4, coalesce(n, 1) AS n FROM base LEFT JOIN yearly USING (category_name))",
        ],
        f"""SELECT category_name, {D} AS period_date, {units(f'CASE WHEN {over} THEN 9500 ELSE {share} END', 4)} AS ecomm_share,
  {units(f'CASE WHEN {over} THEN 500 ELSE {rest} END', 4)} AS retail_share,
  {units(half_up('change4 * 135', '100 * n', 0), 4)} AS ecomm_growth,
  {units(half_up('change4 * 65', '100 * n', 0), 4)} AS retail_growth, 'derived' AS source FROM joined""",
    )

    q["score_inputs"] = sql(
        [*SIGNALS, RUNS, INPUTS],
        "SELECT as_of, category_name, raw_trend, trend_low, trend_high, raw_buzz, raw_demand, raw_spend, avg_listings FROM inputs",
    )
    low = "CAST(min(listing_count) OVER (PARTITION BY source, snapshot_date) AS DOUBLE)"
    high = "CAST(max(listing_count) OVER (PARTITION BY source, snapshot_date) AS DOUBLE)"
    spread = f"(listing_count - {low}) / nullif({high} - {low}, 0) * CAST(100 AS DOUBLE)"
    q["minmax_normalize"] = sql(
        [TRENDS],
        f"SELECT category_name, source, snapshot_date, listing_count, "
        f"CASE WHEN {low} = {high} THEN CAST(50 AS DOUBLE) ELSE {binary_round(spread, 2)} END AS listing_scaled FROM trends",
    )
    q["competition"] = sql(SCORING, "SELECT as_of, category_name, competition_score FROM components")
    q["opportunity_score"] = sql(SCORING, "SELECT as_of, category_name, opportunity_score FROM scored")
    q["channel_edge"] = sql(SCORING, "SELECT scored_at AS as_of, category_name, demand_score, channel_edge FROM scores")
    q["recommendation"] = sql(SCORING, "SELECT category_name, scored_at, recommendation FROM scores")
    q["niche_scores"] = sql(SCORING, f"SELECT {scores_out} FROM scores")
    clean_yoy = "spend AS (SELECT category_name, year, yoy4 FROM expenditure WHERE year > 2000)"
    q["daily_job"] = sql(
        [
            LISTING_FEED,
            RANKED_FEED,
            SEARCH_FEED,
            POST_FEED,
            SPEND_FEED,
            f"""trends AS (
  SELECT category_name, source, snapshot_date, listing_count, price2, sold_count, st4 FROM listings
  UNION ALL SELECT category_name, source, snapshot_date, 0, {cents('price')}, 0, NULL FROM ranked WHERE place = 1)""",
            f"""search AS (
  SELECT category_name, {D} AS snapshot_date, least(greatest(interest_score, 0), 100) AS interest_score FROM points)""",
            "social AS (SELECT * FROM posts)",
            clean_yoy,
            run_list([AS_OF]),
            INPUTS,
            SCORES,
            LEADERBOARD,
        ],
        f"SELECT {BOARD_COLUMNS} FROM leaderboard",
    )

    q["mv_category_leaderboard"] = sql(BOARD, f"SELECT {BOARD_COLUMNS} FROM leaderboard")
    past = f"DATE '{PAST_RUN}'"
    known = [
        f"past AS (SELECT * FROM scores WHERE scored_at <= {past})",
        f"seen AS (SELECT * FROM trends WHERE snapshot_date <= {past})",
    ]

    def as_of_past(view: str) -> str:
        return view.replace("FROM scores", "FROM past").replace("FROM trends", "FROM seen").replace(D, past)

    q["mv_category_leaderboard_past"] = sql([*SCORING, *known, as_of_past(LEADERBOARD)], f"SELECT {BOARD_COLUMNS} FROM leaderboard")
    q["refresh_views_back_fill"] = sql(
        [*SCORING, *known, as_of_past(LEADERBOARD)], f"SELECT {BOARD_COLUMNS}, 1 AS versions FROM leaderboard"
    )
    q["mv_niche_finder_past"] = sql([*SCORING, *known, as_of_past(NICHES)], "SELECT * FROM niches")
    q["daily_job_resumed"] = q["daily_job"]
    q["mv_channel_comparison"] = sql(COMPARE, f"SELECT {COMPARISON_OUT} FROM comparison")
    q["mv_niche_finder"] = sql(NICHE, "SELECT * FROM niches")
    q["mv_trends_explorer"] = sql(EXPLORE, "SELECT * FROM explorer")
    q["refresh_views_touched_days"] = q["mv_trends_explorer"]

    history = "(PARTITION BY category_name ORDER BY snapshot_date)"
    q["wf_sell_through_delta"] = sql(
        [TRENDS],
        f"""SELECT category_name, snapshot_date, listing_count, sold_count, {units('st4', 4)} AS sell_through,
  {units(f'lag(st4) OVER {history}', 4)} AS prev_sell_through, {units(f'st4 - lag(st4) OVER {history}', 2)} AS sell_through_delta,
  lag(listing_count) OVER {history} AS prev_listing_count, listing_count - lag(listing_count) OVER {history} AS listing_delta
FROM trends WHERE source = 'ebay'""",
    )

    def moving(rows: int) -> str:
        frame = f"(PARTITION BY category_name ORDER BY snapshot_date ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW)"
        return units(half_up(f"sum(st4) OVER {frame}", f"count(st4) OVER {frame}", 0), 4)

    q["wf_moving_avg"] = sql(
        [TRENDS],
        f"SELECT category_name, snapshot_date, {units('st4', 4)} AS sell_through, {moving(3)} AS moving_avg_4w, "
        f"{moving(7)} AS moving_avg_8w FROM trends WHERE source = 'ebay'",
    )
    # A daily mean over at most 16 keywords is a whole number of 1/720720.
    frame = "(PARTITION BY category_name ORDER BY snapshot_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    q["wf_interest_momentum"] = sql(
        [
            SEARCH,
            """daily AS (SELECT category_name, snapshot_date, sum(interest_score) AS total, count(interest_score) AS n,
  sum(interest_score) * (720720 // count(interest_score)) AS parts
  FROM search WHERE geo = 'US' GROUP BY category_name, snapshot_date)""",
        ],
        f"""SELECT category_name, snapshot_date, CAST(total AS DOUBLE) / n AS avg_interest,
  {units(half_up(f'parts - lag(parts) OVER {history}', '720720', 2), 2)} AS interest_delta,
  {units(half_up(f'sum(parts) OVER {frame}', f'720720 * count(parts) OVER {frame}', 2), 2)} AS moving_avg_interest FROM daily""",
    )
    q["wf_buzz_momentum"] = sql(
        [
            SOCIAL,
            f"daily AS (SELECT category_name, snapshot_date, {whole('sum(mention_count)')} AS total_mentions FROM social GROUP BY ALL)",
            f"paired AS (SELECT *, lag(total_mentions) OVER {history} AS prev_mentions FROM daily)",
        ],
        f"""SELECT category_name, snapshot_date, total_mentions, prev_mentions, total_mentions - prev_mentions AS mention_delta,
  CASE WHEN prev_mentions > 0 THEN {units(half_up('(total_mentions - prev_mentions) * 100', 'prev_mentions', 2), 2)} END AS mention_growth_pct
FROM paired""",
    )
    q["wf_rank_change"] = sql(
        [
            *SCORING,
            """ranked AS (SELECT category_name, scored_at, opportunity_score,
  CAST(rank() OVER (PARTITION BY scored_at ORDER BY opp2 DESC) AS INTEGER) AS rank_this_week FROM scores)""",
            "paired AS (SELECT *, lag(rank_this_week) OVER (PARTITION BY category_name ORDER BY scored_at) AS rank_last_week FROM ranked)",
        ],
        "SELECT *, rank_this_week - rank_last_week AS rank_change FROM paired",
    )
    q["wf_percentile"] = sql(
        [
            TRENDS,
            f"""placed AS (SELECT category_name, source, snapshot_date, st4, rank() OVER (ORDER BY st4 NULLS LAST) - 1 AS ahead,
  count(*) OVER () AS n, ntile(4) OVER (ORDER BY st4 NULLS LAST, category_name, source) AS quartile
  FROM trends WHERE snapshot_date = {D})""",
        ],
        f"""SELECT category_name, snapshot_date, {units('st4', 4)} AS sell_through,
  CASE WHEN n = 1 THEN 0 ELSE {units(half_up('ahead * 100', 'greatest(n - 1, 1)', 1), 1)} END AS sell_through_percentile,
  CAST(quartile AS INTEGER) AS demand_quartile FROM placed""",
    )

    for name in ("wf_sell_through_delta", "wf_moving_avg", "wf_interest_momentum", "wf_buzz_momentum"):
        q[f"{name}_by_loads"] = q[name]

    q["cte_score_breakdown"] = sql(
        [
            *everything,
            f"""i AS (SELECT category_name, {half_up('sum(interest_score)', 'count(interest_score)', 2)} AS v FROM search
  WHERE geo = 'US' AND snapshot_date BETWEEN {D} - 30 AND {D} GROUP BY category_name)""",
            f"""b AS (SELECT category_name, {whole('sum(mention_count)')} AS m, count(DISTINCT subreddit) AS s FROM social
  WHERE snapshot_date BETWEEN {D} - 7 AND {D} GROUP BY category_name)""",
            f"""d AS (SELECT category_name, {half_up('sum(st4)', 'count(st4)', 0)} AS st, {half_up('sum(price2)', 'count(price2)', 0)} AS price,
  {whole('sum(listing_count)')} AS listings FROM trends WHERE snapshot_date BETWEEN {D} - 7 AND {D} GROUP BY category_name)""",
            f"""e AS (SELECT category_name, {half_up('sum(yoy4)', 'count(yoy4)', 0)} AS g, max(spend2) AS top FROM spend
  WHERE year BETWEEN year({D}) - 3 AND year({D}) GROUP BY category_name)""",
            f"""c AS (SELECT category_name, {half_up('sum(share4)', 'count(share4)', 0)} AS sh, {half_up('sum(growth4)', 'count(growth4)', 0)} AS gr
  FROM channels WHERE period_date BETWEEN {D} - 30 AND {D} GROUP BY category_name)""",
            "n AS (SELECT * FROM scores WHERE scored_at = (SELECT max(scored_at) FROM scores))",
        ],
        f"""SELECT category_name, {units('coalesce(v, 0)', 2)} AS trend_interest, coalesce(m, 0) AS buzz_mentions,
  coalesce(s, 0) AS subreddit_spread, {units('coalesce(st, 0)', 2)} AS sell_through_pct, {units('coalesce(price, 0)', 2)} AS avg_price,
  coalesce(listings, 0) AS total_listings, {units('coalesce(g, 0)', 2)} AS spend_growth_pct,
  {units('coalesce(top, 0)', 2)} AS annual_spend_usd, {units('coalesce(sh, 0)', 2)} AS ecomm_share_pct,
  {units('coalesce(gr, 0)', 2)} AS ecomm_growth_pct, {SCORE_COLUMNS}
FROM d LEFT JOIN i USING (category_name) LEFT JOIN b USING (category_name) LEFT JOIN e USING (category_name)
  LEFT JOIN c USING (category_name) LEFT JOIN n USING (category_name)""",
    )

    def rising(per_date: bool) -> str:
        def newest(order: str) -> str:
            return "" if per_date else f" QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY {order}) = 1"

        return sql(
            [
                *SCORING,
                f"""i0 AS (SELECT category_name, snapshot_date, sum(interest_score) AS s, count(interest_score) AS n FROM search
  WHERE snapshot_date BETWEEN {D} - 14 AND {D} GROUP BY ALL)""",
                f"i1 AS (SELECT *, s * lag(n) OVER {history} > lag(s) OVER {history} * n AS up FROM i0)",
                f"i AS (SELECT category_name, up FROM i1{newest('snapshot_date DESC')})",
                f"b0 AS (SELECT category_name, snapshot_date, sum(mention_count) AS s FROM social WHERE snapshot_date BETWEEN {D} - 14 AND {D} GROUP BY ALL)",
                f"b1 AS (SELECT *, s > lag(s) OVER {history} AS up FROM b0)",
                f"b AS (SELECT category_name, up FROM b1{newest('snapshot_date DESC')})",
                f"d AS (SELECT category_name, st4 > 1500 AS up FROM trends WHERE snapshot_date = {D}{newest('source DESC')})",
                f"e AS (SELECT category_name, yoy4 > 0 AS up FROM spend WHERE year = year({D}) - 1)",
                """flags AS (SELECT category_name, opportunity_score, recommendation,
  CAST(coalesce(i.up, false) AS INTEGER) + CAST(coalesce(b.up, false) AS INTEGER) + CAST(coalesce(d.up, false) AS INTEGER)
    + CAST(coalesce(e.up, false) AS INTEGER) AS signals_positive
  FROM scores LEFT JOIN i USING (category_name) LEFT JOIN b USING (category_name) LEFT JOIN d USING (category_name)
    LEFT JOIN e USING (category_name) WHERE scored_at = (SELECT max(scored_at) FROM scores))""",
            ],
            """SELECT *, CASE WHEN signals_positive >= 3 THEN 'Rising' WHEN signals_positive <= 1 THEN 'Declining' ELSE 'Mixed' END
  AS momentum_label FROM flags""",
        )

    q["cte_rising_categories"] = rising(per_date=False)
    q["cte_rising_categories_per_date"] = rising(per_date=True)
    q["cte_channel_gap"] = sql(
        [
            CHANNELS,
            f"""gap AS (SELECT category_name, {half_up('sum(share4)', '100 * count(share4)', 1)} AS share1,
  {half_up('sum(retail4)', '100 * count(retail4)', 1)} AS retail1, {half_up('sum(growth4)', 'count(growth4)', 0)} AS growth2,
  max(share4) - min(share4) AS gain2 FROM channels GROUP BY category_name)""",
        ],
        f"""SELECT category_name, {units('share1', 1)} AS avg_ecomm_share_pct, {units('retail1', 1)} AS avg_retail_share_pct,
  {units('growth2', 2)} AS avg_ecomm_growth_pct, {units('gain2', 2)} AS share_gain_pct,
  CASE WHEN share1 > 550 THEN 'E-comm dominant' WHEN share1 < 300 THEN 'Retail dominant' ELSE 'Contested' END AS channel_status,
  CASE WHEN growth2 > 500 AND share1 < 450 THEN 'Early mover opportunity' WHEN growth2 > 500 THEN 'Growing — competitive'
    WHEN growth2 < 0 THEN 'E-comm contracting' ELSE 'Stable' END AS opportunity_label FROM gap""",
    )
    one = "category_name = 'Electronics'"
    q["cte_deep_dive"] = sql(
        [
            *SCORING,
            f"""points AS (
  (SELECT 'demand' AS signal_type, snapshot_date AS period, {units('st4', 2)} AS value, {units('price2', 2)} AS secondary_value
    FROM trends WHERE {one} ORDER BY snapshot_date DESC, source DESC LIMIT 12)
  UNION ALL (SELECT 'interest', snapshot_date, {units(half_up('sum(interest_score)', 'count(interest_score)', 1), 1)}, NULL
    FROM search WHERE {one} AND geo = 'US' GROUP BY snapshot_date ORDER BY snapshot_date DESC LIMIT 12)
  UNION ALL (SELECT 'buzz', snapshot_date, CAST(sum(mention_count) AS DOUBLE), {units(half_up('sum(score2)', '100 * count(score2)', 1), 1)}
    FROM social WHERE {one} GROUP BY snapshot_date ORDER BY snapshot_date DESC LIMIT 12))""",
            f"best AS (SELECT opportunity_score, recommendation FROM scores WHERE {one} ORDER BY scored_at DESC LIMIT 1)",
        ],
        "SELECT * FROM points CROSS JOIN best",
    )
    run = "DATE '2024-01-24'"
    q["cte_top_entries"] = sql(
        [*everything, f"past AS (SELECT * FROM scores WHERE scored_at <= {run})"],
        f"""SELECT p.category_name, opportunity_score, demand_score, trend_score, buzz_score, competition_score, channel_edge,
  {units('price2', 2)} AS avg_price, {units('st4', 4)} AS sell_through, {units('share4', 4)} AS ecomm_share, {units('growth4', 4)} AS ecomm_growth
FROM past p LEFT JOIN trends t ON t.category_name = p.category_name AND t.snapshot_date = {run} AND t.source = 'ebay'
  LEFT JOIN channels c ON c.category_name = p.category_name AND c.period_date = (SELECT max(period_date) FROM channels WHERE period_date <= {run})
WHERE scored_at = (SELECT max(scored_at) FROM past) AND recommendation = 'enter' AND opp2 >= 6000 AND price2 BETWEEN 1500 AND 20000""",
    )

    q["get_leaderboard"] = sql(
        BOARD,
        f"SELECT category_name, {SCORE_COLUMNS}, momentum, score_delta, current_rank, avg_price, sell_through, listing_count FROM leaderboard",
    )
    q["get_score_history"] = sql(SCORING, "SELECT category_name, scored_at, opportunity_score FROM scores")
    q["get_rising_declining"] = sql(
        BOARD, "SELECT category_name, opportunity_score, score_delta, momentum, recommendation, channel_edge FROM leaderboard"
    )
    q["get_channel_comparison"] = q["mv_channel_comparison"]
    q["get_channel_summary"] = sql([*COMPARE, SUMMARY], "SELECT * FROM summary")
    q["get_niche_finder"] = sql(
        NICHE,
        f"SELECT {NICHE_READ} FROM niches WHERE opportunity_score >= 30 AND recommendation = 'watch' AND avg_price <= 150",
    )
    q["get_category_timeseries"] = sql(
        EXPLORE,
        "SELECT snapshot_date, sell_through_pct, avg_price, listing_count, sold_count, search_interest, reddit_mentions, source "
        f"FROM explorer WHERE {one}",
    )
    q["get_category_score_breakdown"] = sql(NICHE, f"SELECT {NICHE_READ} FROM niches WHERE {one}")
    chosen = "category_name IN ('Electronics', 'Pet Supplies', 'Toys & Hobbies')"
    q["get_trends_explorer"] = sql(
        EXPLORE,
        f"SELECT category_name, snapshot_date, search_interest AS value FROM explorer WHERE {chosen} AND snapshot_date BETWEEN {D} - 14 AND {D}",
    )
    q["get_all_category_names"] = sql(NICHE, "SELECT DISTINCT category_name FROM niches")

    q["momentum_counts"] = sql(BOARD, "SELECT momentum, count(*) AS categories FROM leaderboard GROUP BY momentum")
    avg4 = units(half_up("sum(opp2)", "100 * count(opp2)", 4), 4)
    delta4 = units(half_up("sum(delta2)", "100 * count(delta2)", 4), 4)
    reference4 = units(
        f"{half_up('sum(opp2)', '100 * count(opp2)', 4)} - {half_up('sum(delta2)', '100 * count(delta2)', 4)}", 4
    )
    q["market_gauge"] = sql(
        BOARD,
        f"""SELECT count(*) AS categories, {avg4} AS avg_score, {delta4} AS avg_delta,
  (SELECT category_name FROM leaderboard ORDER BY opp2 DESC, category_name LIMIT 1) AS top_category, {units('max(opp2)', 2)} AS top_score,
  count(*) FILTER (momentum = 'Rising') AS rising, count(*) FILTER (momentum = 'Declining') AS declining, {reference4} AS reference_score
FROM leaderboard""",
    )
    q["avg_component_scores"] = sql(
        BOARD,
        " UNION ALL ".join(
            f"SELECT '{c}' AS component, {units(half_up(f'sum(CAST(round({c} * 100) AS BIGINT))', '100 * count(*)', 4), 4)} AS avg_score FROM leaderboard"
            for c in catalog.SCORE_WEIGHTS
        ),
    )
    q["channel_status_counts"] = sql(
        [*COMPARE, SUMMARY],
        """SELECT count(*) FILTER (channel_status = 'E-comm dominant') AS ecomm_dominant,
  count(*) FILTER (channel_status = 'Retail dominant') AS retail_dominant, count(*) FILTER (channel_status = 'Contested') AS contested,
  count(*) FILTER (opportunity_label = 'Early mover opportunity') AS early_movers FROM summary""",
    )
    q["channels_by_share"] = q["channels_by_growth"] = q["get_channel_summary"]
    q["niche_kpis"] = sql(
        SCORING + [NICHES],
        f"""SELECT count(*) AS matched, {units(half_up('sum(o2)', '100 * nullif(count(o2), 0)', 4), 4)} AS avg_score,
  count(*) FILTER (recommendation = 'enter') AS enter
FROM (SELECT CAST(round(opportunity_score * 100) AS BIGINT) AS o2, recommendation FROM niches WHERE opportunity_score >= 30)""",
    )
    q["latest_values"] = sql(
        EXPLORE,
        f"""SELECT category_name, value FROM (SELECT category_name, avg_price AS value FROM explorer WHERE {chosen}
  QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY snapshot_date DESC, avg_price DESC) = 1)
ORDER BY value DESC, category_name""",
    )
    q["score_sparkline"] = sql(
        SCORING,
        """SELECT category_name, string_agg(CAST(opp2 AS VARCHAR), ',' ORDER BY scored_at) AS scores FROM scores
GROUP BY category_name HAVING count(*) >= 2""",
    )
    q["score_band"] = sql(
        SCORING,
        """SELECT category_name, scored_at, CASE WHEN opp2 >= 6500 THEN 'positive' WHEN opp2 >= 4000 THEN 'warning'
  ELSE 'negative' END AS band FROM scores""",
    )
    return q
