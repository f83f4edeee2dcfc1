"""Type-2 history ("check" strategy): a new version whenever any check column changes.

Snapshot columns: key, check columns, ``scd_id``, ``updated_at``, ``valid_from``,
``valid_to`` (NULL while current). ``scd_id = md5(key|updated_at)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmart.functions.scalars import changed, surrogate_key
from linkmart.operators.scan import blocked, neighbour
from linkmart.operators.shred import field, json_field, text_field, with_parsed
from linkmart.operators.upsert import changed_keys, require_unique
from linkmart.operators.records import _ts
from linkmart.session import guard_union_partitioning
from linkmart.plans.spec import EntitySpec
from linkmart.sources.buckets import merged

META = ["scd_id", "updated_at", "valid_from", "valid_to"]


def snapshot_source(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """The rows a snapshot run compares: id plus check columns read from the payload
    (text columns as ``->>``, json columns as ``->``). Ids are trimmed so they join the
    staged (trimmed) ids."""
    cols = [F.trim(field(text_field(spec.key))).alias(spec.key)]
    for k, kind in spec.snapshot_columns():
        cols.append(field(json_field(k) if kind == "json" else text_field(k)).alias(k))
    return with_parsed(raw, spec).select(*cols)


def empty_snapshot(source: DataFrame) -> DataFrame:
    return source.where(F.lit(False)).select(
        "*",
        F.lit(None).cast("string").alias("scd_id"),
        F.lit(None).cast("timestamp").alias("updated_at"),
        F.lit(None).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def scd2_step(current: DataFrame | None, source: DataFrame, now, key: str = "id",
              check_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """One snapshot run over the *current slice* only: ``(closed, current_next)``.

    ``closed`` are the current versions that end at ``now`` (``valid_to = now``);
    ``current_next`` is the next current slice (untouched versions plus versions
    opened at ``now``). History is not read at all, so a run costs O(entities).

    Plan: changed keys come from joining (key, fingerprint of check columns) of the
    current slice and the source, so only those narrow pairs are shuffled; the current
    slice is then left-joined to the changed-key set and the source semi-joined to it.
    AQE broadcasts the changed-key set when it is small. A key twice in ``source`` raises."""
    require_unique(source, key)
    check = check_cols or [c for c in source.columns if c != key]
    guard_union_partitioning(source.sparkSession)
    t = _ts(now)
    if current is None:  # first run: every key opens a version, nothing to join
        first = source.select(
            key, *check, surrogate_key(F.col(key), t).alias("scd_id"), t.alias("updated_at"),
            t.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
        return empty_snapshot(source.select(key, *check)), first
    cur = current.select(key, *check, *META)
    src = source.select(key, *check)
    ch = changed_keys(cur, src, key, check)
    closing = ch.where(~F.col("_new")).select(key, F.lit(True).alias("_close"))
    marked = cur.join(closing, key, "left")
    closed = marked.where(F.col("_close")).select(
        key, *check, "scd_id", "updated_at", "valid_from", t.alias("valid_to"))
    kept = marked.where(F.col("_close").isNull()).select(key, *check, *META)
    opened = src.join(ch, key, "left_semi").select(
        key, *check,
        surrogate_key(F.col(key), t).alias("scd_id"), t.alias("updated_at"),
        t.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    return closed, kept.unionByName(opened)


def scd2_bucketed(current: DataFrame | None, source: DataFrame, now, key: str = "id",
                  check_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``scd2_step`` for a current slice that is bucketed by ``key``: the same two frames out of one
    merge join, so the slice is neither shuffled nor sorted and its next version stays in
    its buckets."""
    if current is None:
        return scd2_step(None, source, now, key, check_cols)
    require_unique(source, key)
    check = check_cols or [c for c in source.columns if c != key]
    t = _ts(now)
    cur, src = F.col("_c"), F.col("_s")
    rows = merged(current.select(key, *check, *META), source.select(key, *check), key)
    moved = src.isNotNull() & (cur.isNull() | changed([cur[c] for c in check], [src[c] for c in check]))
    closed = rows.where(cur.isNotNull() & moved).select(
        key, *[cur[c].alias(c) for c in [*check, "scd_id", "updated_at", "valid_from"]], t.alias("valid_to"))
    opened = {**{c: src[c] for c in check}, "scd_id": surrogate_key(F.col(key), t), "updated_at": t, "valid_from": t,
              "valid_to": F.lit(None).cast("timestamp")}
    nxt = rows.withColumn("_moved", moved).select(
        key, *[F.when(F.col("_moved"), new).otherwise(cur[c]).alias(c) for c, new in opened.items()])
    return closed, nxt


def scd2_merge(snapshot: DataFrame | None, source: DataFrame, now, key: str = "id",
               check_cols: list[str] | None = None) -> DataFrame:
    """One snapshot run at ``now`` over a whole snapshot (history + current).

    New key -> version from ``now``; any check column changed (null-safe) -> close the
    current version at ``now`` and open a new one; unchanged or absent from ``source``
    -> untouched (idempotent re-runs). ``source`` must be unique on ``key``. Closed
    history passes through untouched; see ``scd2_step`` for the plan."""
    check = check_cols or [c for c in source.columns if c != key]
    if snapshot is None:
        return scd2_step(None, source, now, key, check)[1]
    cur = snapshot.where(F.col("valid_to").isNull())
    hist = snapshot.where(F.col("valid_to").isNotNull()).select(key, *check, *META)
    closed, current_next = scd2_step(cur, source, now, key, check)
    return hist.unionByName(closed).unionByName(current_next)


def scd2_replay(changes: DataFrame, key: str, order_col: str,
                check_cols: list[str] | None = None) -> DataFrame:
    """All versions produced by applying ``changes`` batch by batch.

    ``changes`` must be unique on (key, order_col): pre-aggregate to one row per key and
    batch. Same result as a ``scd2_merge`` per batch. Each row is compared with the one before
    it and each version takes its end from the next one by two-level scans (see ``scan``),
    so a key of any size spreads over tasks."""
    check = check_cols or [c for c in changes.columns if c not in (key, order_col)]
    rows = neighbour(blocked(changes.select(key, order_col, *check), key, order_col), key, order_col, check, "_prev")
    moved = changed([F.col("_prev")[c] for c in check], [F.col(c) for c in check])
    kept = rows.where(F.col("_prev").isNull() | moved).drop("_prev")
    versions = neighbour(kept, key, order_col, [order_col], "_next", step=1)
    return versions.select(
        key, *check,
        surrogate_key(F.col(key), F.col(order_col)).alias("scd_id"),
        F.col(order_col).alias("updated_at"),
        F.col(order_col).alias("valid_from"),
        F.col("_next")[order_col].alias("valid_to"),
    )
