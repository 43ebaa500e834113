"""Keyed insert-or-update as a join."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.keyed import first_per_key


def last_per_key(batch: DataFrame, keys: list[str], last_first: list[Column] | None) -> DataFrame:
    """The record that wins inside a batch. Without an order the batch must hold each key once."""
    return first_per_key(batch, keys, last_first) if last_first else batch


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: list[str],
    last_first: list[Column] | None = None,
    defaults: dict | None = None,
) -> DataFrame:
    """Rows of ``existing`` with ``batch`` merged in on ``keys``.

    Only the columns the batch supplies are updated; new rows take ``defaults`` (or NULL) elsewhere.
    ``last_first`` orders records of one key so that the one to keep comes first. A full-width batch
    needs only an anti join, which Spark broadcasts when the batch's keys are small, so the table is
    not shuffled; a partial one needs both sides.
    """
    winners = last_per_key(batch, keys, last_first)
    types = {f.name: f.dataType for f in existing.schema}
    supplied = [c for c in existing.columns if c in winners.columns]
    winners = winners.select(*[F.col(c).cast(types[c]).alias(c) for c in supplied])
    if len(supplied) == len(existing.columns):
        return existing.join(winners.select(*keys), keys, "left_anti").select(*existing.columns).unionByName(winners)

    updates = winners.select(
        *keys,
        F.lit(True).alias("_new"),
        *[F.col(c).alias(f"_new_{c}") for c in supplied if c not in keys],
    )
    merged = existing.withColumn("_old", F.lit(True)).join(updates, keys, "full_outer")

    def merged_column(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in supplied:
            return F.when(F.col("_new"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
        default = F.lit((defaults or {}).get(name)).cast(types[name])
        return F.when(F.col("_old"), F.col(name)).otherwise(default).alias(name)

    return merged.select(*[merged_column(c) for c in existing.columns])
