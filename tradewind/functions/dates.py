"""Dates as they are spelled in landed feeds."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values: spellings besides ISO dates and timestamps; the month comes first where both could ---
SPELLINGS = [
    "M/d/yyyy",
    "M-d-yyyy",
    "yyyy/M/d",
    "yyyy.M.d",
    "yyyyMMdd",
    "d MMM yyyy",
    "d MMMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d-MMM-yyyy",
    "M/d/yyyy HH:mm:ss",
    "M/d/yyyy HH:mm",
]


def read_date(df: DataFrame, name: str) -> str:
    """The column as a date, NULL where no spelling fits."""
    if not isinstance(df.schema[name].dataType, T.StringType):
        return f"CAST({name} AS date)"
    # A weekday before the day says nothing more.
    tidy = f"regexp_replace(trim({name}), '^(?i)(mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +', '')"
    others = ", ".join(f"CAST(try_to_timestamp({tidy}, '{spelling}') AS date)" for spelling in SPELLINGS)
    return f"coalesce(try_cast({name} AS date), {others})"


def required_date(df: DataFrame, name: str) -> str:
    """The column as a date; one that no spelling fits fails the job."""
    return f"coalesce({read_date(df, name)}, CAST({name} AS date))"
