"""One row per key, safe for a key that holds a third of all rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], limit: int | None = 1) -> DataFrame:
    """The first rows of each key (all with ``limit`` None), numbered in ``_position``.

    A filter on ``row_number`` becomes a WindowGroupLimit on both sides of the exchange: each map task
    sends at most ``limit`` rows per key. Without a limit a key's rows are sorted, and spilled, in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    placed = df.withColumn("_position", F.row_number().over(window))
    return placed if limit is None else placed.where(f"_position <= {int(limit)}")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_key(df, keys, order).drop("_position")


def first_by_ordinal(df: DataFrame, keys: list[Column], ordinal: str) -> DataFrame:
    """Rows whose ``ordinal``, a fixed-width number that no two rows share, is the least of their keys.

    The least one is a hash aggregate over keys and ordinal alone, so nothing is sorted and each map task sends a number
    per key; the winners' numbers then pick the rows."""
    winners = df.groupBy(*keys).agg(F.min(ordinal).alias(ordinal)).select(ordinal)
    return df.join(winners, ordinal, "left_semi")


def latest_per_key(df: DataFrame, key: str, columns: list[str], *newest: str) -> DataFrame:
    """``columns`` of the newest row per key; later ``newest`` columns settle ties, greatest first.

    An aggregate with map-side combine: each map task sends one row per key.
    """
    order = newest[0] if len(newest) == 1 else f"struct({', '.join(newest)})"
    row = F.expr(f"max_by(struct({', '.join(columns)}), {order}) AS _newest")
    return df.groupBy(key).agg(row).select(key, *[f"_newest.{c}" for c in columns])
