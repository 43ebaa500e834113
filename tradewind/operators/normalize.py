"""Min-max scaling to 0..100 inside groups."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numeric import round_binary


def scale_to_100(value: str, low: str, high: str) -> str:
    """(value - low) / (high - low) x 100 to 2 digits; 50 where all values are equal."""
    scaled = round_binary(f"try_divide({value} - {low}, {high} - {low}) * 100D", 2)
    return f"CASE WHEN {high} = {low} THEN 50D ELSE {scaled} END"


def with_minmax(df: DataFrame, value: str, out: str, by: list[str]) -> DataFrame:
    """Scale one column inside each group.

    The bounds come from a hash aggregate with map-side combine, not from a window that would gather
    each group in one task.
    """
    bounds = df.groupBy(*by).agg(
        F.expr(f"min(CAST({value} AS double)) AS _low"), F.expr(f"max(CAST({value} AS double)) AS _high")
    )
    scaled = scale_to_100(f"CAST({value} AS double)", "_low", "_high")
    # Null-safe: rows of a NULL group are a group like any other.
    same = reduce(and_, (F.col(f"v.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by))
    return df.alias("v").join(bounds.alias("b"), same).selectExpr(*[f"v.{c}" for c in df.columns], f"{scaled} AS {out}")
