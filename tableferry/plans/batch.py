"""One job per table for many tables; a failing table does not stop the others."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outcome:
    table: str
    path: str | None
    error: str | None = None


def for_each_table(spark: SparkSession, jobs: Mapping[str, Callable[[], str]], at_once: int = 4) -> list[Outcome]:
    """Run the jobs, a few at a time so that small tables fill the gaps large ones leave."""

    def run(table: str) -> Outcome:
        try:
            return Outcome(table, jobs[table]())
        except Exception as e:  # noqa: BLE001 - reported per table
            log.exception("%s failed", table)
            return Outcome(table, None, f"{type(e).__name__}: {e}")

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(run), jobs))
