"""Facts read from the running session; the library never changes its settings."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SCRATCH_DATABASE = "tableferry_scratch"


@cache
def _local_scratch() -> str:
    return "file:" + tempfile.mkdtemp(prefix="tableferry-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    A machine-local folder is used only in local mode with nothing configured, as in tests: executors
    of a cluster could not read each other's files there, so a cluster without the setting is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody wrote to before."""
    return f"{scratch_root(spark)}/tableferry/{name}-{uuid.uuid4().hex}"


def fresh_table(spark: SparkSession, name: str) -> str:
    """An unused table name in the scratch database, whose files lie in the shared folder."""
    if not spark.catalog.databaseExists(SCRATCH_DATABASE):
        location = fresh_path(spark, "database")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{location}'")
    return f"{SCRATCH_DATABASE}.{name}_{uuid.uuid4().hex}"


def adaptive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


def recommended(cores: int, shuffled_bytes: int = 0) -> dict[str, str]:
    """Settings for whoever builds the session; results do not depend on them.

    ``shuffled_bytes`` is the largest table to be shuffled: partitions of 256 MB fit in memory, and
    adaptive execution joins the ones that turn out small.  The number grows with the data: 100 TB
    give 400,000 partitions, for which the driver needs memory for the sizes that map tasks report.
    """
    split = 256 * 1024 * 1024
    partitions = -(-shuffled_bytes // split)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(max(cores, partitions, 1)),
        # Fixed value: input splits of a full unload.
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        # One listing task per core instead of one per partition directory.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(max(cores, 1)),
    }
