"""Independent writes at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Independent jobs submitted at once; they share the executors.
THREADS = 4


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Results of all jobs, in order; the first failure is raised after all ended."""
    with ThreadPoolExecutor(THREADS) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [one.result() for one in waiting]
