"""Versioned Parquet tables.

Parquet has no MERGE and a path cannot be overwritten while it is being read, so a
keyed table is a folder of versions ``<base>/v=<n>``; a version counts once its
``_SUCCESS`` marker exists (written by the output committer after every task
succeeded). A failed or lost job leaves the previous version as the current one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class VersionedTable:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, self.base)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v="):
                if fs.exists(st.getPath().suffix("/_SUCCESS")):
                    out.append(int(name[2:]))
        return sorted(out)

    def path(self, version: int) -> str:
        return f"{self.base}/v={version:08d}"

    def current(self) -> DataFrame | None:
        vs = self.versions()
        return self.spark.read.parquet(self.path(vs[-1])) if vs else None

    def next_version(self) -> int:
        vs = self.versions()
        return (vs[-1] + 1) if vs else 1

    def commit(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Write the next version. A folder of that number that a failed job left behind is
        not a version (it has no ``_SUCCESS``), and is replaced."""
        n = self.next_version()
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(n))
        return n

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` committed versions (and any uncommitted
        folder older than them). Returns the removed version numbers. Run it only when no
        reader still uses an old version."""
        keep = max(1, keep)
        vs = self.versions()
        if len(vs) <= keep:
            return []
        oldest_kept = vs[-keep]
        fs, p = _fs(self.spark, self.base)
        removed = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v=") and int(name[2:]) < oldest_kept:
                fs.delete(st.getPath(), True)
                removed.append(int(name[2:]))
        return sorted(removed)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


class SnapshotStore:
    """Type-2 history stored as two tables so a run never rewrites old versions:

      <base>/history/slice_v=N/closed_on=<date>   the versions closed by the run that committed
                                            slice N, partitioned by the day they closed
      <base>/current/v=N                    the current slice (one row per entity)

    A run reads only the current slice, writes the versions it closed under the number of
    the slice it is about to commit, then commits the slice. Readers ignore history above
    the committed slice, so a run that fails between the two writes leaves nothing behind,
    and its retry, at whatever time, replaces what it wrote. Versions that the same day
    has already closed are not closed twice."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.current_table = VersionedTable(spark, f"{self.base}/current")

    def current(self) -> DataFrame | None:
        return self.current_table.current()

    def _history(self, like: DataFrame) -> DataFrame | None:
        """Committed history with ``closed_on``."""
        fs, p = _fs(self.spark, f"{self.base}/history")
        if not fs.exists(p):
            return None
        schema = StructType(like.schema.fields + [
            StructField("slice_v", IntegerType()), StructField("closed_on", DateType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.base}/history")
        return rows.where(F.col("slice_v") < self.current_table.next_version()).drop("slice_v")

    def history(self) -> DataFrame | None:
        cur = self.current()
        h = None if cur is None else self._history(cur)
        return None if h is None else h.drop("closed_on")

    def snapshot(self) -> DataFrame | None:
        cur = self.current()
        if cur is None:
            return None
        hist = self._history(cur)
        return cur if hist is None else hist.drop("closed_on").unionByName(cur)

    def commit(self, closed: DataFrame, current_next: DataFrame, now, **how) -> DataFrame:
        """``how`` goes to the commit of the current slice."""
        from linkmart.operators.records import _ts

        n = self.current_table.next_version()
        day = F.to_date(_ts(now))
        fresh = closed.withColumn("closed_on", day)
        seen = self._history(closed)
        if seen is not None:
            seen = seen.where(F.col("closed_on") == day).select("scd_id")
            fresh = fresh.join(seen, "scd_id", "left_anti").select(*closed.columns, "closed_on")
        (fresh.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("closed_on").parquet(f"{self.base}/history/slice_v={n}"))
        assert self.current_table.commit(current_next, **how) == n
        return self.spark.read.parquet(self.current_table.path(n))
