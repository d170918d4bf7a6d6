"""Distinct texts laid out once, so that later joins by their key don't move them; and scratch tables that go again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableferry.session import fresh_path, fresh_table

#: Bytes of text that a bucket should hold at most, and for which another bucket is worth a task.
BUCKET_BYTES, LEAST_BUCKET_BYTES = 256 << 20, 4 << 20


def buckets_for(spark: SparkSession, n_bytes: int) -> int:
    """Buckets by bytes: as many as keep all cores busy, more where they would get large, none beyond the engine's limit.

    Above the limit (100,000 by default, so 25 TB of text) buckets grow: a task streams its bucket in Arrow batches and
    sorts it with spilling, so a larger one takes longer but not more memory.
    """
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    busy = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // LEAST_BUCKET_BYTES))
    return max(1, min(most, max(busy, -(-n_bytes // BUCKET_BYTES))))


class Scratch:
    """Tables between the steps of one operator, in the shared folder; each can be removed after its last reader."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: dict[str, str] = {}
        self._tables: dict[str, str] = {}

    def written(self, rows: DataFrame, name: str) -> DataFrame:
        path = self._paths[name] = fresh_path(self.spark, name)
        rows.write.parquet(path)
        return self.spark.read.parquet(path)

    def bucketed(self, rows: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
        table = self._tables[name] = fresh_table(self.spark, name)
        rows.write.bucketBy(buckets, column).saveAsTable(table)
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        for name in names or [*self._paths, *self._tables]:
            if path := self._paths.pop(name, None):
                target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
            if table := self._tables.pop(name, None):
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
