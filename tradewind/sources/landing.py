"""Landed text feeds, with damaged lines set apart.

A feed is parsed once: its lines are written as Parquet with their order of arrival, damaged ones with their text, and
counted on the way. Beyond a share of damaged lines the feed itself is wrong, and the run stops.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import schemas
from tradewind.sources.arrival import ARRIVAL, with_text_arrival
from tradewind.sources.shared import written

MOST_DAMAGED = 0.01
_DAMAGED = "_damaged"


class DamagedFeed(ValueError):
    """More lines of a feed are damaged than may be."""


@dataclass
class Landed:
    """rows: in the declared schema, with ``_arrival``; damaged: line, _arrival; and how many there are of each."""

    rows: DataFrame
    damaged: DataFrame
    row_count: int
    damaged_count: int


def _landed(scan: DataFrame, name: str, most_damaged: float) -> Landed:
    watch = Observation(f"landed-{name}")
    counted = [F.expr(f"count_if({_DAMAGED} IS NULL)").alias("good"), F.expr(f"count({_DAMAGED})").alias("bad")]
    kept = written(with_text_arrival(scan).observe(watch, *counted), f"landed-{name}")
    good, bad = watch.get["good"], watch.get["bad"]
    if bad > most_damaged * (good + bad):
        raise DamagedFeed(f"{bad} of {good + bad} lines of {name} are damaged")
    damaged = kept.where(f"{_DAMAGED} IS NOT NULL").select(F.col(_DAMAGED).alias("line"), ARRIVAL)
    return Landed(kept.where(f"{_DAMAGED} IS NULL").drop(_DAMAGED), damaged, good, bad)


def _with_damaged(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_DAMAGED, T.StringType())])


def land_json(
    spark: SparkSession, path: str, schema: T.StructType, name: str = "feed", most_damaged: float = MOST_DAMAGED
) -> Landed:
    """A feed of one JSON object a line: lines that are no such object, or hold another type, are damaged."""
    reader = spark.read.schema(_with_damaged(schema)).option("mode", "PERMISSIVE")
    return _landed(reader.option("columnNameOfCorruptRecord", _DAMAGED).json(path), name, most_damaged)


def land_spend_csv(spark: SparkSession, path: str, most_damaged: float = MOST_DAMAGED) -> Landed:
    """The expenditure CSV: rows with too few or too many fields, or with no number in its place, are damaged.

    A missing file is an empty feed."""
    reader = spark.read.schema(_with_damaged(schemas.SPEND_FEED)).option("mode", "PERMISSIVE").option("header", True)
    try:
        scan = reader.option("columnNameOfCorruptRecord", _DAMAGED).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], T.StructType([*schemas.SPEND_FEED.fields, T.StructField(ARRIVAL, T.DecimalType(38, 0))]))
        return Landed(empty, spark.createDataFrame([], f"line string, {ARRIVAL} decimal(38,0)"), 0, 0)
    return _landed(scan, "spend", most_damaged)
