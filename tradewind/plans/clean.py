"""Cleaning of signal batches and the derived channel-share table.

Every function takes a batch with the table's columns in whatever types they arrived and returns the
table's declared types, one row per key: of several rows with one key the first stays. ``first`` says which that is:
the name of a column that numbers the rows as they arrived (``sources.arrival`` makes one), or columns to order by.
Missing numbers are NULL; a date that no spelling fits or a NULL category fails, so batches that may hold such rows go
through ``sources.quarantine`` first.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind import catalog, schemas
from tradewind.functions.dates import required_date
from tradewind.functions.literals import day, text, text_map
from tradewind.functions.numeric import clamp, number, round_binary, whole_number
from tradewind.functions.text import normalize_category, required, strip
from tradewind.operators.keyed import first_by_ordinal, first_per_key


def _category() -> Column:
    """The normalized category; catalogue names, by far the most rows, are already in that form."""
    name = F.col("category_name")
    tidy = F.when(name.isin(catalog.CATEGORIES), name).otherwise(normalize_category(name))
    return required(tidy, "category_name")


def _finish(table: str, batch: DataFrame, first: list[Column] | str, columns: dict[str, Column | str]) -> DataFrame:
    keys = schemas.KEYS[table]
    cleaned = {c: F.expr(e) if isinstance(e, str) else e for c, e in columns.items()}
    if isinstance(first, str):
        # Keys and the ordinal decide which rows stay; everything else is only read and worked out for those.
        kept = first_by_ordinal(batch, [cleaned.get(k, F.col(k)).alias(k) for k in keys], first).withColumns(cleaned)
        return schemas.typed(kept, schemas.TABLES[table])
    kept = first_per_key(batch.withColumns({c: e for c, e in cleaned.items() if c in keys}), keys, first)
    rest = {c: e for c, e in cleaned.items() if c not in keys}
    return schemas.typed(kept.withColumns(rest) if rest else kept, schemas.TABLES[table])


def clean_category_trends(batch: DataFrame, first: list[Column] | str) -> DataFrame:
    return _finish(
        "category_trends",
        batch,
        first,
        {
            "category_name": _category(),
            "snapshot_date": required_date(batch, "snapshot_date"),
            "avg_price": round_binary(number(batch, "avg_price"), 2),
            "listing_count": whole_number(batch, "listing_count"),
            "sold_count": whole_number(batch, "sold_count"),
            "sell_through": round_binary(clamp(number(batch, "sell_through"), "0D", "1D"), 4),
            "rank_position": number(batch, "rank_position"),
        },
    )


def clean_search_signals(batch: DataFrame, first: list[Column] | str) -> DataFrame:
    return _finish(
        "search_signals",
        batch,
        first,
        {
            "keyword": F.lower(strip("keyword")),
            "category_name": _category(),
            "snapshot_date": required_date(batch, "snapshot_date"),
            "interest_score": clamp(whole_number(batch, "interest_score"), 0, 100),
            "geo": "upper(coalesce(geo, 'US'))",
        },
    )


def clean_social_buzz(batch: DataFrame, first: list[Column] | str) -> DataFrame:
    return _finish(
        "social_buzz",
        batch,
        first,
        {
            "category_name": _category(),
            "keyword": F.lower(strip("keyword")),
            "subreddit": strip("subreddit"),
            "snapshot_date": required_date(batch, "snapshot_date"),
            "mention_count": whole_number(batch, "mention_count"),
            "avg_score": round_binary(f"coalesce({number(batch, 'avg_score')}, 0D)", 2),
        },
    )


def clean_consumer_spend(batch: DataFrame, first: list[Column] | str) -> DataFrame:
    year = whole_number(batch, "year")
    return _finish(
        "consumer_spend",
        batch.where(f"{year} > 2000"),
        first,
        {
            "category_name": _category(),
            "year": year,
            "avg_annual_spend": round_binary(number(batch, "avg_annual_spend"), 2),
            "yoy_change": round_binary(number(batch, "yoy_change"), 4),
        },
    )


def union_sources(first: DataFrame, second: DataFrame | None) -> DataFrame:
    """Cleaned listings of the marketplace and, when it ran, of the ranked lists."""
    return first if second is None else first.unionByName(second, allowMissingColumns=True)


def build_retail_vs_ecomm(spend: DataFrame, as_of: date) -> DataFrame:
    """Online and retail share per catalogue category, estimated from spend growth.

    Growth is 1.35 x (online) and 0.65 x (retail) the mean yearly change; the online share is its base
    plus a tenth of the online growth, at most 0.95. A category without spend rows has growth 0; one
    with rows but no known change stays NULL. No spend at all gives no rows. Computed in decimals,
    rounded half up.
    """
    known = F.expr(f"CASE WHEN category_name IN ({', '.join(text(c) for c in catalog.BASE_ONLINE_SHARE)}) THEN category_name END")
    growth = spend.groupBy(known.alias("category")).agg(
        F.expr("count(*) AS row_count"),
        F.expr("CAST(sum(yoy_change) AS decimal(18,4)) AS change"),
        F.expr("count(yoy_change) AS changes"),
    )
    # A row for each catalogue category and one for the rest: together a single row, which is there for no spend too.
    together = growth.agg(
        F.expr("count(*) AS found"),
        F.expr("collect_list(struct(category, struct(row_count, change, changes) AS figures)) AS by_category"),
    )
    base = together.where("found > 0").selectExpr(
        f"explode({text_map(catalog.BASE_ONLINE_SHARE)}) AS (category_name, base)",
        "map_from_entries(filter(by_category, e -> e.category IS NOT NULL)) AS growth",
    )

    def mean_change(factor: str) -> str:
        """factor x mean change; multiplied before dividing, so that exact halves stay exact."""
        return (
            f"CASE WHEN row_count IS NULL THEN 0 "
            f"ELSE try_divide(change * CAST({factor} AS decimal(4,3)), CAST(changes AS decimal(10,0))) END"
        )

    share = f"CAST(base AS decimal(5,4)) + {mean_change('0.135')}"
    # CASE, not least(): least() would turn an unknown share into 0.95.
    return schemas.typed(
        base.selectExpr("category_name", "base", "try_element_at(growth, category_name) AS figures")
        .select("category_name", "base", "figures.*")
        .withColumn("share", F.expr(f"CASE WHEN {share} > 0.95 THEN 0.95 ELSE {share} END"))
        .selectExpr(
            "category_name",
            f"{day(as_of)} AS period_date",
            "round(share, 4) AS ecomm_share",
            "round(1 - share, 4) AS retail_share",
            f"round({mean_change('1.35')}, 4) AS ecomm_growth",
            f"round({mean_change('0.65')}, 4) AS retail_growth",
            f"{text(catalog.DERIVED)} AS source",
        ),
        schemas.RETAIL_VS_ECOMM,
    )
