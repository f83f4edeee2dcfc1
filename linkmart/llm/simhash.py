"""SimHash near-duplicates through a deletion-variant index.

Fingerprint: ASCII-lower-cased text, words split on ASCII white space, word shingles with
repeats, XXH64 (seed 42) of each; a bit is set when it is set in more than half of the
hashes. A text with fewer words than the shingle length is one shingle; one without words
(NULL and empty texts too) has fingerprint 0 and is linked like any other.

Two fingerprints within 2 bits agree on one of their two 32-bit halves up to one bit. So
each half is indexed once per wildcard position (one bit masked out): two halves share an
entry exactly when they differ in nothing but that bit. Pairs come from an equality join
on those entries, are verified by their XOR, and are accepted only at the first entry they
share, so each link appears once.

A bucket of more than ``HOT_BUCKET`` fingerprints is not joined with itself. Its members
are put under their 65 variants with at most one bit flipped instead: two fingerprints
within 2 bits share such a variant (a point between them), and each variant links its
members to the smallest one. That is exact for reachability and linear in the members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.llm.common import merging, stored, utf8
from linkmart.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
HOT_BUCKET = 32
_BLOCK = 4096


def fingerprint(raw: bytes, width: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of one UTF-8 text."""
    words = raw.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, n = xxhash.xxh64_intdigest, len(starts)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        cut = zip(starts[at: at + _BLOCK].tolist(), ends[at: at + _BLOCK].tolist())
        h = np.array([digest(text[a:b], SEED) for a, b in cut], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp) of every row of ``docs``; other columns are not read."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(raw.as_py(), width) for raw in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("raw")).mapInArrow(run, f"id {kind}, fp bigint")


def _entries(fps: DataFrame) -> DataFrame:
    """The 64 one-wildcard entries (key, v, fp) of each fingerprint."""
    return (
        fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
        .selectExpr("fp", "v", "CASE WHEN v < 32 THEN shiftrightunsigned(fp, 32) ELSE fp & 4294967295L END AS half")
        .selectExpr("shiftleft(CAST(v AS BIGINT), 32) | (half & ~shiftleft(1L, v % 32)) AS key", "v", "fp")
    )


def _first_shared(x: Column, v: Column) -> Column:
    """Whether entry ``v`` is the first that two fingerprints with XOR ``x`` share."""
    high = F.shiftrightunsigned(x, 32)
    wild = F.expr("shiftleft(1L, a.v % 32)")
    return (
        F.when(high == 0, v == 0)
        .when(F.bit_count(high) == 1, (v < 32) & (wild == high))
        .otherwise(v == 32)
    )


def links(spark: SparkSession, fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fps(fp)`` such that two fingerprints are
    connected exactly when a chain of steps of at most ``max_bits`` (1 or 2) bits joins them.
    """
    if max_bits not in (1, 2):
        raise ValueError("two halves with one wildcard cover at most 2 differing bits")
    entries = _entries(fps)
    sizes = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(spark, entries.join(merging(sizes), "key"), "simhash-members")

    cool = members.where(F.col("n") <= hot)
    a, b = cool.select("key", "v", "fp").alias("a"), cool.select("key", "fp").alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    near = a.join(
        merging(b),
        (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(x) <= max_bits) & _first_shared(x, F.col("a.v")),
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    crowd = members.where(F.col("n") > hot).select("fp").distinct()
    if max_bits == 2:
        flips = crowd.select("fp", F.explode(F.array(F.lit(0).cast("long"), *[F.expr(f"shiftleft(1L, {i})") for i in range(64)])).alias("bit"))
        at = flips.select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("point"))
    else:  # one bit apart: the masked fingerprint and its mask are equal
        flips = crowd.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
        at = flips.selectExpr("fp", "struct(v, fp & ~shiftleft(1L, v)) AS point")
    least = at.groupBy("point").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
    starred = at.join(merging(least), "point").where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return near.union(starred)


def simhash_components(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET,
) -> DataFrame:
    """One row (id, fp, component) per row of ``docs``; ``component`` is the smallest id
    reachable over links of at most ``max_bits`` bits, its own included.

    Copies are reduced to their distinct fingerprint before the index, so a group of any
    size costs one entry set. Repeated rows each get a row; a NULL id gets a row and never
    names a component unless the whole component has NULL ids.
    """
    prints = stored(spark, fingerprints(docs, id_col, text_col, width), "simhash-prints")
    distinct = stored(spark, prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = connected_components(spark, links(spark, distinct.select("fp"), max_bits, hot))
    placed = distinct.join(merging(roots), distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = stored(spark, placed, "simhash-placed")
    named = placed.groupBy("root").agg(F.min("least").alias("component"))
    by_print = stored(spark, placed.join(merging(named), "root").select("fp", "component"), "simhash-named")
    return prints.join(merging(by_print), "fp").select("id", "fp", "component")
