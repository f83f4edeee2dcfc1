"""Keyed tables bucketed by their key, so that a run does not shuffle what is already stored.

Each version is a bucketed Parquet table of Spark, one file per bucket, sorted by the key. The
number of buckets is metadata of the key column in the files themselves, so a version is read
with the buckets it was written with, in any session, and a table that was written without
buckets (or with another number) is taken over by the next commit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.session import scratch_dir
from linkmart.sources.tables import SnapshotStore, VersionedTable, _fs

BUCKETS = "buckets"


def _buckets_of(df: DataFrame, key: str) -> int:
    return df.schema[key].metadata.get(BUCKETS, 0)


class BucketedTable(VersionedTable):
    """``buckets`` for the versions to come: about the table's size over 256 MB, as one task
    reads one bucket."""

    def __init__(self, spark: SparkSession, base: str, key: str, buckets: int):
        super().__init__(spark, base)
        self.key, self.buckets = key, buckets

    def _name(self, path: str) -> str:
        return "linkmart_" + hashlib.sha256(path.encode()).hexdigest()[:24]

    def current(self) -> DataFrame | None:
        """The newest version, its scan partitioned and sorted by the key if it has buckets.
        Sorted scans of one file per bucket are behind a session setting, set here."""
        plain = super().current()
        if plain is None or not _buckets_of(plain, self.key):
            return plain
        self.spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        path = self.path(self.versions()[-1])
        name, key, n = self._name(path), self.key, _buckets_of(plain, self.key)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # of an earlier read; files stay
        columns = plain._jdf.schema().toDDL()
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
                       f"SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def in_place(self) -> bool:
        """Whether the newest version has the buckets that commits write."""
        plain = super().current()
        return plain is not None and _buckets_of(plain, self.key) == self.buckets

    def commit(self, df: DataFrame, partition_by: list[str] | None = None, aligned: bool = False) -> int:
        """Write the next version. ``aligned``: the rows of a bucket already lie in one partition,
        as after a join with ``current()`` on the key that keeps its rows; else they are shuffled by it once."""
        if partition_by:
            raise ValueError("a bucketed table has no partition columns")
        n = self.next_version()
        path = self.path(n)
        if not (aligned and self.in_place()):
            if df.isEmpty():  # buckets without rows have no file to tell the columns
                return super().commit(df)
            df = df.repartition(self.buckets, self.key)
        marked = df.withMetadata(self.key, {BUCKETS: self.buckets})
        name = self._name(path)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        (marked.write.format("parquet").mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key)
         .option("path", path).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # its entry only: the table is external
        return n


class BucketedSnapshotStore(SnapshotStore):
    """A snapshot store whose current slice is bucketed by ``key``."""

    def __init__(self, spark: SparkSession, base: str, key: str, buckets: int):
        super().__init__(spark, base)
        self.current_table = BucketedTable(spark, f"{self.base}/current", key, buckets)

    def commit(self, closed: DataFrame, current_next: DataFrame, now) -> DataFrame:
        return super().commit(closed, current_next, now, aligned=True)


@contextmanager
def staged(rows: DataFrame, key: str, buckets: int) -> Iterator[DataFrame]:
    """``rows`` written once in ``buckets`` buckets to the shared scratch folder and read back: however
    often they are used, they are computed and shuffled once. Deleted at the end."""
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, "staged")
    table = BucketedTable(spark, path, key, buckets)
    try:
        table.commit(rows)
        yield table.current()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table._name(table.path(1))}")
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def merged(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``key``, ``_c``, ``_s``: the rows of both sides of a key as structs, NULL where a side has none.
    A row of ``right`` without a key is left out. A full outer merge join, so with a bucketed
    ``left`` only ``right`` is shuffled, and the result keeps the buckets."""
    c = left.select(key, F.struct(*left.columns).alias("_c"))
    s = right.where(F.col(key).isNotNull()).select(key, F.struct(*right.columns).alias("_s"))
    return c.join(s.hint("merge"), key, "full_outer")
