"""Exports by hour or day range into a partitioned target."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from tableferry.functions.dates import HourRange, hour_range_filter
from tableferry.sinks.files import _path, overwrite_partitions


def export_hour_range(df: DataFrame, path: str, partition_by: Sequence[str], hours: HourRange,
                      max_days_per_job: int | None = None, whole_table: bool = False, run: str | None = None) -> str:
    """Export the hours of a partitioned table, replacing the partitions written.

    One job does the whole range: tasks are the unit of work and a lost one is repeated alone.
    ``max_days_per_job`` cuts the range at midnight where jobs must stay short; the result is equal.
    ``whole_table`` copies a table without hours or days, in one job.

    ``run`` names an export that may be cut off: each window of it that is written is entered in a ledger beside the
    target, and the same export, called again under that name, goes on with the windows that are not.  A window that
    was being written is written again, which replaces what there is of it.
    """
    spark = df.sparkSession
    dated = {"dh", "dt", "ds"} & {p.lower() for p in partition_by}
    windows = hours.windows(max_days_per_job) if max_days_per_job and dated else [hours]
    for window in windows:
        if run is not None and window in finished_windows(spark, path, run):
            continue
        rows = df.where(hour_range_filter(partition_by, window, whole_table))
        overwrite_partitions(rows, path, partition_by, clustered=True)
        if run is not None:
            _enter(spark, path, run, window)
    return path


def _ledger(path: str, run: str) -> str:
    # Readers pass over names that begin like this.
    return f"{path.rstrip('/')}/_exports/{quote(run, safe='')}"


def _entry(window: HourRange) -> str:
    return f"{window.start}{'-' if window.include_start else '+'}{window.end}{'-' if window.include_end else '+'}"


def _enter(spark: SparkSession, path: str, run: str, window: HourRange) -> None:
    entry, system = _path(spark, f"{_ledger(path, run)}/{_entry(window)}")
    system.create(entry, True).close()


def finished_windows(spark: SparkSession, path: str, run: str) -> list[HourRange]:
    """The windows of a named export that are in its target, in order."""
    folder, system = _path(spark, _ledger(path, run))
    if not system.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(folder))
    return [HourRange(n[:10], n[11:21], n[10] == "-", n[21] == "-") for n in names]
