"""Run independent Spark actions together.

Each callable triggers its own Spark job(s); submitted from a few threads,
the jobs share the cluster, so small ones fill the cores a large one leaves
idle.  Threads inherit the caller's job group, pool and description.  Results
keep the input order of names.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def run_together(jobs: dict[str, Callable[[], T]], workers: int = 4) -> dict[str, T]:
    if workers <= 1 or len(jobs) <= 1:
        return {name: job() for name, job in jobs.items()}
    spark = SparkSession.getActiveSession()
    carry = inheritable_thread_target(spark) if spark is not None else inheritable_thread_target
    with ThreadPoolExecutor(max_workers=min(workers, len(jobs))) as pool:
        futures = {name: pool.submit(carry(job)) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}
