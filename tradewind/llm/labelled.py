"""A bounded, balanced sample of labelled documents to fit a model on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import ship_package


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, features: Column, per_class: int, usable: Column | None = None
) -> list[tuple[int, object]]:
    """Up to `per_class` documents of label 1 and as many of label 0, as (label, features), in a fixed order.

    `features` is an expression over the text; it is evaluated for drawn documents only.

    The ids are drawn from `labels` by a hash of the id, so that the draw doesn't depend on the order of rows;
    only rows where `usable` is true take part. At most 2 * per_class ids are broadcast, and, even if an id stands
    on many rows of docs, as many feature values at most come to the driver. Null ids, labels other than 0 and 1
    and ids that contradict themselves are left out. Empty tables give an empty list.
    """
    ship_package(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if usable is not None:
        known = known.where(usable)
    known = (
        known.groupBy("doc_id")
        .agg(F.min(label).alias("_label"), F.max(label).alias("_most"))
        .where("_label = _most")
        .select("doc_id", "_label", F.xxhash64("doc_id").alias("_draw"))
    )
    drawn = [known.where(F.col("_label") == value).orderBy("_draw", "doc_id").limit(per_class) for value in (0, 1)]
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))
    rows = docs.select("doc_id", "text").join(ids, "doc_id").select("doc_id", "_label", "_draw", features.alias("_features"))
    return [(r["_label"], r["_features"]) for r in rows.orderBy("_draw", "doc_id", "_features").limit(2 * per_class).collect()]


def balanced_order(rng: np.random.Generator, labels: list[int]) -> np.ndarray:
    """A random order of the rows in which those of the rarer label come again until both are as frequent."""
    sides = [side for side in (np.flatnonzero(np.array(labels) == y) for y in (0, 1)) if len(side)]
    most = max(map(len, sides), default=0)
    return rng.permutation(np.concatenate([np.resize(rng.permutation(side), most) for side in sides])) if sides else np.zeros(0, int)
