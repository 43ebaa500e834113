"""The signal tables and read models as partitioned Parquet in one shared folder."""

import time
import uuid
from collections.abc import Callable, Collection
from datetime import date
from functools import partial

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import schemas
from tradewind.functions.literals import day
from tradewind.operators.upsert import upsert
from tradewind.plans import increments, views
from tradewind.sources import quarantine
from tradewind.sources.folders import Folder
from tradewind.sources.together import run_together

_CURRENT = "CURRENT"
_VERSION = "v-"
#: The read model that is stored by date and whose dates can be renewed one by one, and the tables behind it.
SERIES = "mv_trends_explorer"
SERIES_TABLES = ("category_trends", "search_signals", "social_buzz")


class Loaded(int):
    """The number of records of a load, with the partitions (dates or years) that it touched."""

    partitions: frozenset

    def __new__(cls, records: int, partitions: Collection = ()) -> "Loaded":
        loaded = super().__new__(cls, records)
        loaded.partitions = frozenset(partitions)
        return loaded


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under a declared schema; nothing written yet is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _refuse_unless_keyed(table: str, batch: DataFrame, keys: list[str], column: str, last_first: list[Column] | None) -> None:
    missing = " OR ".join(f"{name} IS NULL" for name in dict.fromkeys([*keys, column]))
    if not batch.where(missing).isEmpty():
        raise ValueError(f"a record for {table} has no {' or '.join(dict.fromkeys([*keys, column]))}")
    if last_first is None and not batch.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"the batch for {table} holds a key more than once and no order tells which record wins")


class SignalStore:
    """Reads and writes the tables below ``root``, a folder every executor reaches.

    Writes replace whole partitions: Spark stages the new files and swaps them in when the job commits,
    so a lost executor or a failed job leaves the old rows in place, and a table may be read by the
    job that rewrites some of its partitions.

    Read models are published in versions: a refresh writes a whole version beside the current one, then a pointer is
    renamed into place, then old versions go. A refresh that fails leaves pointer and version as they were.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table_path(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def view_path(self, view: str) -> str:
        """The folder of a read model's versions."""
        return f"{self.root}/views/{view}"

    def window_path(self, query: str) -> str:
        return f"{self.root}/windows/{query}"

    def tail_path(self, query: str) -> str:
        return f"{self.root}/tails/{query}"

    def read(self, table: str) -> DataFrame:
        schema = schemas.TABLES[table]
        return read_table(self.spark, self.table_path(table), schema).select(*schema.names)

    def _replace_partitions(self, rows: DataFrame, path: str, column: str) -> None:
        # Rebalancing gathers each partition's rows in few files and still splits one that is large.
        (
            rows.hint("rebalance", F.col(column))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(path)
        )

    def upsert(self, table: str, batch: DataFrame, last_first: list[Column] | None = None) -> Loaded:
        """Merge a batch on the table's key and return the number of batch records and the partitions they touched.

        Only the partitions the batch touches are read and rewritten. The batch is kept while it is
        used more than once: to check and count it and to merge it. A batch with a NULL in its key or
        partition column, or with a key twice and no ``last_first`` to tell which record wins, is
        refused whole, before anything is written.
        """
        keys, column = schemas.KEYS[table], schemas.PARTITION_COLUMN[table]
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _refuse_unless_keyed(table, batch, keys, column, last_first)
            # One row per day (or year) of the batch.
            touched = dict(batch.groupBy(column).count().collect())
            if not touched:
                return Loaded(0)
            existing = self.read(table).where(F.col(column).isin(list(touched)))
            merged = upsert(existing, batch, keys, last_first, schemas.DEFAULTS[table])
            self._replace_partitions(merged, self.table_path(table), column)
            return Loaded(sum(touched.values()), touched)
        finally:
            batch.unpersist()

    def load_category_trends(self, batch: DataFrame, last_first: list[Column] | None = None) -> Loaded:
        return self.upsert("category_trends", batch, last_first)

    def load_search_signals(self, batch: DataFrame, last_first: list[Column] | None = None) -> Loaded:
        return self.upsert("search_signals", batch, last_first)

    def load_social_buzz(self, batch: DataFrame, last_first: list[Column] | None = None) -> Loaded:
        return self.upsert("social_buzz", batch, last_first)

    def load_consumer_spend(self, batch: DataFrame, last_first: list[Column] | None = None) -> Loaded:
        return self.upsert("consumer_spend", batch, last_first)

    def load_retail_vs_ecomm(self, batch: DataFrame, last_first: list[Column] | None = None) -> Loaded:
        return self.upsert("retail_vs_ecomm", batch, last_first)

    def load_niche_scores(self, batch: DataFrame, last_first: list[Column] | None = None) -> Loaded:
        return self.upsert("niche_scores", batch, last_first)

    def reset_tables(self) -> None:
        """Empty all six tables."""
        for table, schema in schemas.TABLES.items():
            (
                self.spark.createDataFrame([], schema)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .parquet(self.table_path(table))
            )

    def reject(self, table: str, rejected: DataFrame, as_of: date) -> None:
        """Rows that could not be cleaned, as records of the run's date; running a date again replaces them."""
        self._replace_partitions(
            quarantine.as_records(table, rejected).withColumn("run_date", F.lit(as_of)),
            f"{self.root}/rejects/{table}",
            "run_date",
        )

    def read_rejects(self, table: str) -> DataFrame:
        """table_name, reason, record, run_date."""
        schema = "table_name string, reason string, record string, run_date date"
        return read_table(self.spark, f"{self.root}/rejects/{table}", T._parse_datatype_string(schema))

    # --- versions ---

    def _current(self, path: str) -> str | None:
        """The folder of the current version, None before the first."""
        version = Folder(self.spark, path).read(_CURRENT)
        return None if version is None else f"{path}/{version}"

    def _publish(self, path: str, write: Callable[[str], None], keep: int = 1) -> None:
        """Write a version, point to it, and drop all earlier ones but the last ``keep`` (with the new one).

        Readers that took the pointer before may still read an earlier version while it is kept."""
        folder, version = Folder(self.spark, path), f"{_VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        try:
            write(f"{path}/{version}")
        except Exception:
            folder.delete(version)
            raise
        folder.replace(_CURRENT, version)
        earlier = [name for name in folder.names() if name.startswith(_VERSION) and name < version]
        for name in earlier[: len(earlier) - keep + 1]:
            folder.delete(name)

    # --- read models ---

    def view_builders(self, as_of: date, dates: Collection[date] | None = None) -> dict[str, Callable[[], DataFrame]]:
        """Each read model's plan, built when it is its turn; ``dates`` limits the series to these."""

        def some(table: str) -> DataFrame:
            rows = self.read(table)
            return rows if dates is None else rows.where(F.col("snapshot_date").isin(list(dates)))

        return {
            "mv_category_leaderboard": lambda: views.mv_category_leaderboard(
                self.read("niche_scores"), self.read("category_trends"), as_of
            ),
            "mv_channel_comparison": lambda: views.mv_channel_comparison(self.read("retail_vs_ecomm")),
            "mv_niche_finder": lambda: views.mv_niche_finder(
                self.read("niche_scores"),
                self.read("category_trends"),
                self.read("search_signals"),
                self.read("social_buzz"),
                self.read("consumer_spend"),
                as_of,
            ),
            SERIES: lambda: views.mv_trends_explorer(*map(some, SERIES_TABLES)),
        }

    def refresh_views(self, as_of: date, touched: Collection[date] | None = None, keep: int = 1) -> dict[str, str]:
        """Recompute the read models as of a day; one that fails, in its plan or its job, is reported and the others go on.

        ``touched`` are the dates that the loads since the last refresh of this kind touched: then only these dates of the
        series are read and rewritten, in its current version."""
        builders = self.view_builders(as_of, touched)

        def refresh(name: str) -> str:
            path = self.view_path(name)
            try:
                if name != SERIES:
                    self._publish(path, lambda version: builders[name]().write.parquet(version), keep)
                elif touched is None or (current := self._current(path)) is None:
                    whole = self.view_builders(as_of)[name]
                    self._publish(path, lambda version: self._replace_partitions(whole(), version, "snapshot_date"), keep)
                elif touched:
                    self._replace_partitions(builders[name](), current, "snapshot_date")
                return "refreshed"
            except Exception as error:  # noqa: BLE001 - reported per view, as the contract asks
                return f"failed: {error}"

        return run_together(self.spark, {name: partial(refresh, name) for name in builders})

    def read_view(self, view: str) -> DataFrame:
        """The published version of a read model."""
        current = self._current(self.view_path(view))
        if current is None:
            raise ValueError(f"{view} has not been published")
        stored = self.spark.read.parquet(current)
        return stored.select(*views.SERIES_COLUMNS) if view == SERIES else stored

    # --- momentum queries, kept up to date by day ---

    def refresh_momentum(self, touched: Collection[date]) -> dict[str, int]:
        """Bring the stored momentum queries up to date after loads that touched these dates; rows written of each.

        Everything from the first of them on is worked out anew, behind the tail of what lies before. A tail that was
        stored stands for history if it ends before that day; otherwise, as when late rows come in, it is taken from the
        signals once more."""
        first = min(touched)

        def refresh(name: str) -> int:
            query, path = increments.MOMENTUM[name], self.tail_path(name)
            signals, current = self.read(query.table), self._current(path)
            tail = self.spark.read.parquet(current) if current else None
            if tail is None or not tail.where(f"snapshot_date >= {day(first)}").isEmpty():
                tail = increments.tail_before(query.daily(signals), first)
            behind = increments.with_tail(name, signals, first, tail).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self._replace_partitions(increments.over_new_days(name, behind, first), self.window_path(name), "snapshot_date")
                self._publish(path, increments.tail_before(behind).write.parquet)
                return behind.where(f"snapshot_date >= {day(first)}").count()
            finally:
                behind.unpersist()

        return run_together(self.spark, {name: partial(refresh, name) for name in increments.MOMENTUM})

    def read_momentum(self, query: str) -> DataFrame:
        """The stored rows of a momentum query."""
        return self.spark.read.parquet(self.window_path(query))
