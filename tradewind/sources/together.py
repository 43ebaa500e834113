"""Independent Spark jobs submitted at the same time.

A job on daily aggregates leaves most of a cluster idle; independent loads overlap instead of queueing
behind each other's driver-side planning.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(spark: SparkSession, jobs: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Results by name, in the order given; the first failure is raised once all have ended."""
    if len(jobs) < 2:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}
