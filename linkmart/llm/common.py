"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.session import scratch_dir


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared scratch folder and read it back.

    Cuts lineage so that a lost executor costs a re-read, not a recomputation, and gives
    each later use the same rows.
    """
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merging(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast. For tables that grow with the input:
    Spark sizes a stored table by its compressed files and an ``explode`` like what it explodes, so
    one of gigabytes can look smaller than ``spark.sql.autoBroadcastJoinThreshold``."""
    return df.hint("merge")


def crc_mod(id_col: str | Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")) % n


def hash_share(n: int, total: int, *cols: str) -> Column:
    """Keeps rows by a hash of ``cols``: about ``n`` of ``total``, all if there are fewer. Put
    before an ordered limit, whose every task would otherwise send its own ``n`` rows."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) < int(min(1.0, n / max(1, total)) * (1 << 30))


def utf8(col: str) -> Column:
    """Text as UTF-8 bytes, NULL as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")
