"""Session settings the engine is designed for, and jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: partition coalescing, skewed-join splitting, and
    # switching to a broadcast join once the real size of a side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app: str = "ledgerloom", master: str | None = None, **extra: str
) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` keys use ``__`` in place of ``.``."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def at_once(spark: SparkSession, jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Results of independent jobs that Spark runs side by side, one thread each.

    All of them end, also if one fails; the first failure in the given order is
    raised then.
    """
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        started = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
    return {name: job.result() for name, job in started.items()}
