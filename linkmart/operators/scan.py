"""The previous or next row of a key, for keys of any size.

A window over a key puts all its rows into one task. Here the rows are range-sorted by
(key, order), so a key that holds a third of all rows spreads over many blocks. A window per
(block, key) finds neighbours inside a block; the first or last row of a key in a block finds
its neighbour in a table of borders, which has rows only for keys that go over the end of
a block: at most two for each block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkmart.session import scratch_dir

BLOCK = "_block"


def blocked(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``rows`` range-sorted by (key, order), written to the shared scratch folder and read back
    with ``_block``, the part of the sort a row is in. Rows equal in both may fall into two."""
    spark = rows.sparkSession
    path = scratch_dir(spark, "blocked")
    spread = rows.repartitionByRange(key, order).sortWithinPartitions(key, order)
    spread.withColumn(BLOCK, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def neighbour(rows: DataFrame, key: str, order: str, values: list[str], out: str, step: int = -1) -> DataFrame:
    """``blocked`` rows with ``out``: the ``values`` (a struct, and NULL if there is none) of the
    previous (``step=-1``) or next (``step=1``) row of the same key in the order. Keys are
    compared null-safely; ``order`` is unique within a key."""
    value = F.struct(*[F.col(v) for v in values])
    inside = Window.partitionBy(BLOCK, key).orderBy(order)
    shifted = F.lag(value).over(inside) if step < 0 else F.lead(value).over(inside)
    edge = (F.max_by if step < 0 else F.min_by)(value, F.col(order)).alias("_edge")
    edges = rows.groupBy(key, BLOCK).agg(edge)
    across = Window.partitionBy(key).orderBy(BLOCK)  # a row per block that the key is in
    edges = edges.select(F.col(key).alias("_k"), F.col(BLOCK).alias("_b"),
                         (F.lag("_edge") if step < 0 else F.lead("_edge")).over(across).alias("_edge")).where("_edge IS NOT NULL")
    joined = rows.withColumn(out, shifted).join(
        edges, F.col(key).eqNullSafe(F.col("_k")) & (F.col(BLOCK) == F.col("_b")), "left")
    return joined.withColumn(out, F.coalesce(out, "_edge")).drop("_k", "_b", "_edge")
