"""Batches split into rows that can be cleaned and rows that cannot, in one pass."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tradewind.functions.dates import read_date
from tradewind.sources.shared import written

REASON = "_reason"
#: Columns without which a row has no place in its table, and the column that must be a date.
NEEDED = {
    "category_trends": (["category_name", "source"], "snapshot_date"),
    "search_signals": (["keyword", "category_name"], "snapshot_date"),
    "social_buzz": (["category_name", "keyword", "subreddit"], "snapshot_date"),
    "consumer_spend": (["category_name"], None),
}


@dataclass
class Split:
    """clean: the rows as they came; rejected: the others with a reason in ``_reason``; counts by reason."""

    clean: DataFrame
    rejected: DataFrame
    counts: dict[str, int]

    @property
    def rejects(self) -> int:
        return sum(self.counts.values())


def reason(table: str, batch: DataFrame) -> str:
    """Why a row cannot be cleaned: the first reason that holds, NULL for a good row."""
    needed, day = NEEDED[table]
    cases = [(f"no {column}", f"{column} IS NULL") for column in needed]
    if day:
        cases.append((f"no {day}", f"{day} IS NULL"))
        cases.append((f"unreadable {day}", f"{read_date(batch, day)} IS NULL"))
    return "CASE " + " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in cases) + " END"


def reasons(table: str) -> list[str]:
    needed, day = NEEDED[table]
    return [f"no {c}" for c in [*needed, *([day] if day else [])]] + ([f"unreadable {day}"] if day else [])


def split(table: str, batch: DataFrame) -> Split:
    """The batch is read once and written with its reasons; what was rejected is counted while it is written."""
    watch = Observation(f"rejected-{table}")
    names = reasons(table)
    counted = [F.expr(f"count_if({REASON} = '{name}')").alias(f"r{i}") for i, name in enumerate(names)]
    marked = batch.withColumn(REASON, F.expr(reason(table, batch))).observe(watch, *counted)
    kept = written(marked, f"split-{table}")
    counts = {name: watch.get[f"r{i}"] for i, name in enumerate(names)}
    return Split(
        kept.where(f"{REASON} IS NULL").drop(REASON),
        kept.where(f"{REASON} IS NOT NULL"),
        {name: n for name, n in counts.items() if n},
    )


def as_records(table: str, rejected: DataFrame) -> DataFrame:
    """table_name, reason, record (the row as JSON) of rejected rows, whatever their columns."""
    columns = [c for c in rejected.columns if c != REASON]
    return rejected.select(
        F.lit(table).alias("table_name"), F.col(REASON).alias("reason"), F.to_json(F.struct(*columns)).alias("record")
    )
