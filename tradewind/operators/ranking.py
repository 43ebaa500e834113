"""Exact ranks without sorting all rows in one task.

A rank is one plus the number of rows with a better value, so it only needs the count per distinct
value. Scores and shares are fixed-point decimals: at most 10,001 distinct values lie between 0.00
and 100.00 (or 0.0000 and 1.0000). The running count therefore runs over that small tally, whatever
the number of rows, and an equi-join carries it back.

A position among rows that all differ has no such tally. There rows are dealt out by ranges of group and order, so
that a large group is spread over many tasks; a row's position is its place in its task plus the rows of its group in
earlier ones.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.sources.shared import written


def with_rows_ahead(df: DataFrame, value: str, by: list[str], descending: bool) -> DataFrame:
    """Add ``_ahead`` (rows with a better value) and ``_total`` (rows) per ``by`` group.

    NULL values sort first when descending and last when ascending.
    """
    direction = "DESC NULLS FIRST" if descending else "ASC NULLS LAST"
    groups = [f"_by{i}" for i in range(len(by))]
    tally = (
        df.groupBy(*[F.col(b).alias(g) for b, g in zip(by, groups)], F.col(value).alias("_value"))
        .agg(F.expr("count(*) AS _ties"))
    )
    partition = f"PARTITION BY {', '.join(groups)}" if groups else ""
    tally = tally.selectExpr(
        *groups,
        "_value",
        f"coalesce(sum(_ties) OVER ({partition} ORDER BY _value {direction} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _ahead",
        f"sum(_ties) OVER ({partition}) AS _total",
    )
    match = " AND ".join(f"{b} <=> {g}" for b, g in [(value, "_value"), *zip(by, groups)])
    return df.join(tally, F.expr(match), "left").drop(*groups, "_value")


def with_rank(df: DataFrame, value: str, out: str, by: list[str] = (), descending: bool = True) -> DataFrame:
    ranked = with_rows_ahead(df, value, list(by), descending)
    return ranked.selectExpr(*df.columns, f"CAST(_ahead + 1 AS int) AS {out}")


def in_ranges(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """Rows sorted by group and order over many tasks, with ``_range`` (the task) and ``_row`` (the place in it).

    Written, since the borders of ranges are drawn from samples and must be the same for all that reads them."""
    sorting = [*[F.col(c).asc() for c in by], *order]
    placed = df.repartitionByRange(*sorting).sortWithinPartitions(*sorting).withColumn("_row", F.monotonically_increasing_id())
    return written(placed, "ranges").withColumn("_range", F.shiftright("_row", 33))


def with_position(df: DataFrame, by: list[str], order: list[Column], out: str = "_position") -> DataFrame:
    """Number the rows of each ``by`` group from 1 in ``order``; no group is one task's.

    Only counts per group and range meet in a window: as many rows as there are ranges, and groups."""
    ranges = in_ranges(df, by, order)
    counts = ranges.groupBy(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_range").alias("_in")).agg(
        F.min("_row").alias("_first"), F.count("*").alias("_rows")
    )
    groups = [f"_by{i}" for i in range(len(by))]
    earlier = Window.partitionBy(*groups).orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    match = " AND ".join(["_range = _in", *[f"{c} <=> {g}" for c, g in zip(by, groups)]])
    placed = ranges.join(counts, F.expr(match))
    return placed.select(*df.columns, F.expr("_row - _first + _before + 1").alias(out))
