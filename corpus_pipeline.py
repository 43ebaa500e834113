"""The corpus pipeline: documents in, packed pieces out.

Defined cases, by stage. A null or empty text has the quality score of the end mark alone and stays or goes by it; if it
stays, a null text is no copy of anything, empty texts are copies of each other, neither has passages or leaks, and
each is packed as its end id alone. Rows of a null id stay in the copy and passage stages. Rows that share an id but not
the text are documents of their own; repeated rows are one document from the copy stage on. A document of which the
passage stage leaves nothing but white space goes. Texts of any length are read whole. All stages but the last return
the columns of the documents given, also further ones, whatever their names. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import decontamination, near, packing, passages, quality
from tradewind.llm.queries import table, tokenizer_path
from tradewind.llm.shared import ship_package, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject: scores of THRESHOLD and more stay."""
    ship_package(spark)
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(model)(F.col("text")) >= quality.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates."""
    ship_package(spark)
    return near.without_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has."""
    ship_package(spark)
    return passages.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    ship_package(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids."""
    ship_package(spark)
    return packing.sequences(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack),
]

#: No stage but the last is plain SQL, so the tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
