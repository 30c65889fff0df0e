"""A table of answers that grows, bucketed by the hash they are looked up by.

Files of a bucket hold all rows of that part of the hashes, so that a look-up by hash, and choosing among the answers of
one hash, reads the store without an exchange: only what is looked up is dealt. The table is at a path; each session
names it in its own catalogue. Appending writes a file a bucket; ``compact`` makes one of them again.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sinks import file_system

BUCKETS = 16


class Store:
    """Rows of a schema (a DDL string) at a path, bucketed by the column ``key``. The number of buckets belongs to the path."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        self.name = f"store_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"
        self._name()

    def _name(self) -> None:
        spark = self.spark
        where = self.path.replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # the name only; the files stay, since the table is external
        spark.sql(f"CREATE TABLE {self.name} ({self.schema}) USING parquet CLUSTERED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{where}'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        """Rows of the store's columns, in any order; dealt by bucket first, so that a bucket gets one file more."""
        columns = self.spark.table(self.name).columns
        rows.select(*columns).repartition(self.buckets, self.key).write.insertInto(self.name)

    def files(self) -> int:
        return len(self.rows().inputFiles())

    def compact(self, best: DataFrame) -> None:
        """Replace all rows by ``best`` (made of ``rows()``), a file a bucket. They are written beside the store and then
        moved; a run that fails before leaves the store as it was."""
        beside = Store(self.spark, f"{self.path}.{uuid.uuid4().hex}", self.schema, self.key, self.buckets)
        beside.append(best)
        files, at = file_system(self.spark, self.path), self.spark._jvm.org.apache.hadoop.fs.Path
        old = f"{self.path}.old"
        files.delete(at(old), True)
        if not (files.rename(at(self.path), at(old)) and files.rename(at(beside.path), at(self.path))):
            raise OSError(f"cannot move {beside.path} to {self.path}")
        files.delete(at(old), True)
        self.spark.sql(f"DROP TABLE {beside.name}")
        self._name()


def best_by(rows: DataFrame, key: str, order, *columns: str) -> DataFrame:
    """Of the rows of each key the one with the largest ``order``."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("best")).select(key, "best.*")
