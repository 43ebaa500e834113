"""What the operators share: their code on the executors, written intermediate tables, memory of Python workers."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

from tradewind.sources.shared import written

__all__ = ["each", "given_back", "release_memory", "ship_package", "written"]

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Give the executors' Python this package, as spark-submit --py-files would; once an application.

    Operators that run Python in tasks call it, so that they work whether or not the package is installed there."""
    spark = spark or SparkSession.active()
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="tradewind-code-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _SHIPPED.add(app)


def release_memory() -> None:
    """Give back what a task no longer needs. Python workers outlive their tasks, and allocators keep freed memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not with this C library
        pass


def given_back(made: pa.Array) -> pa.Array:
    """The result of a batch, after what the batch needed is given back."""
    release_memory()
    return made


def each(column: pa.Array) -> Iterator:
    """The values of a column as Python objects, one at a time."""
    return (value.as_py() for value in column)
