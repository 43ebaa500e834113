"""Number parsing, clamping and the two roundings the results depend on, as Spark SQL expressions.

The helpers take and return expression text, so they nest freely and reach the JVM as one expression.

Rounding rule. SQL-side results (views, windows, analytical queries) round decimals half away from
zero. Cleaning and scoring round binary doubles half to even after scaling, which is what array
libraries do; ``round_binary`` reproduces that bit for bit with ``rint``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC_TEXT = r"^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$"


def number(df: DataFrame, name: str) -> str:
    """The column as a double, NULL where it does not hold a finite number."""
    if isinstance(df.schema[name].dataType, T.StringType):
        # The pattern keeps out spellings a cast would take but a parser of numbers would not ("12d").
        return f"CASE WHEN {name} RLIKE '{_NUMERIC_TEXT}' THEN try_cast({name} AS double) END"
    return f"nanvl(CAST({name} AS double), CAST(NULL AS double))"


def whole_number(df: DataFrame, name: str) -> str:
    """The column truncated to a whole number, 0 where it does not hold one."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return f"coalesce(CAST({name} AS bigint), 0L)"
    return f"CAST(coalesce({number(df, name)}, 0D) AS bigint)"


def round_binary(value: str, digits: int) -> str:
    return f"rint(({value}) * {10**digits}D) / {10**digits}D"


def clamp(value: str, low: object, high: object) -> str:
    """Limit to [low, high]; NULL stays NULL (least/greatest alone would skip it)."""
    return f"CASE WHEN ({value}) IS NOT NULL THEN least(greatest(({value}), {low}), {high}) END"


def clip_score(name: str) -> Column:
    return F.expr(clamp(name, 0, 100))


def quotient(numerator: str, denominator: str) -> str:
    """Decimal quotient with 16 fractional digits, NULL on division by zero."""
    return f"try_divide(CAST({numerator} AS decimal(28,6)), CAST({denominator} AS decimal(18,0)))"


def ratio(numerator: str, denominator: str, digits: int) -> str:
    return f"round({quotient(numerator, denominator)}, {digits})"


def mean(name: str, digits: int) -> str:
    """Exact rounded mean of an integer or decimal column: exact sum over count, rounded once."""
    return ratio(f"sum({name})", f"count({name})", digits)


def percent(value: str, digits: int) -> str:
    return f"round(({value}) * 100, {digits})"


def mean_percent(name: str, digits: int) -> str:
    return percent(quotient(f"sum({name})", f"count({name})"), digits)


def mean_double(name: str) -> str:
    """Exact sum over count as a double; needs an integer or decimal column to be order-independent."""
    return f"CAST(sum({name}) AS double) / nullif(count({name}), 0)"


def zero_if_missing(name: str) -> str:
    return f"coalesce(CAST({name} AS double), 0D)"
