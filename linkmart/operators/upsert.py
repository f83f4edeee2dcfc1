"""Keyed upsert that only touches rows whose payload changed.

Spark has no MERGE on Parquet, so an upsert is a full outer join of the current table
with the incoming batch on the key (one shuffle, keys unique on both sides), producing
the next version of the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmart.functions.json_ops import canonical_json
from linkmart.operators.records import _ts
from linkmart.operators.scan import blocked, neighbour
from linkmart.session import guard_union_partitioning
from linkmart.sources.buckets import BucketedTable, merged, staged


class DuplicateKeyError(ValueError):
    pass


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` itself; raises if a key occurs twice (one existence check, partial counts)."""
    dup = df.groupBy(key).count().where("count > 1").first()
    if dup is not None:
        raise DuplicateKeyError(f"duplicate {key} {dup[key]!r} in one batch")
    return df


def latest_per_key(df: DataFrame, key: str, order_cols: list[str],
                   on_duplicate: str = "error") -> DataFrame:
    """One row per key. ``on_duplicate="error"`` (the default, as the modelled database's
    page upsert) raises when a key occurs twice; ``"last"`` keeps the row with the
    greatest ``order_cols`` (later page/pos wins).

    ``max_by`` is a partial aggregate: a hot key is combined map-side, never collected."""
    if on_duplicate == "error":
        require_unique(df, key)
    others = [c for c in df.columns if c != key]
    order = F.struct(*[F.col(c) for c in order_cols])
    latest = F.max_by(F.struct(*[F.col(c) for c in others]), order)
    return df.groupBy(key).agg(latest.alias("_r")).select(key, "_r.*")


def fingerprint(*cols) -> Column:
    """SHA-256 of the JSON text of the columns (NULL fields left out, so NULL and ''
    differ), as 32 bytes. Used to find changed keys by shuffling (key, 32 bytes)
    instead of whole rows; equal fingerprints mean equal values barring a SHA-256
    collision."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.unhex(F.sha2(F.to_json(F.struct(*cs)), 256))


def changed_keys(current: DataFrame, incoming: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Keys of ``incoming`` that are new or whose ``cols`` differ from ``current``:
    ``(key, _new)``, each once. Only (key, fingerprint) pairs are shuffled."""
    c = current.select(key, fingerprint(*cols).alias("_cf"))
    i = incoming.select(key, fingerprint(*cols).alias("_if"))
    d = i.join(c, key, "left")
    return d.where(~F.col("_cf").eqNullSafe(F.col("_if"))).select(
        key, F.col("_cf").isNull().alias("_new")).dropDuplicates([key])


def _canonical(payload: Column) -> Column:
    """The payload as it is stored: canonical JSON, or text that is not JSON as it is."""
    return F.coalesce(canonical_json(payload), payload)


def _batch(incoming: DataFrame, key: str, payload: str, on_duplicate: str) -> DataFrame:
    """``(key, payload)`` of a batch: canonical payloads, each key once."""
    incoming = incoming.select(key, _canonical(F.col(payload)).alias(payload))
    return (latest_per_key(incoming, key, [payload], "last") if on_duplicate == "last"
            else require_unique(incoming, key))


def upsert_changed(current: DataFrame | None, incoming: DataFrame, now, key: str = "id",
                   payload: str = "payload", ts: str = "extracted_at",
                   on_duplicate: str = "error",
                   derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Next version of a keyed table ``(key, payload, ts)``, with ``derive`` (such as
    ``shred.with_parsed``) also the columns it adds, computed for new payloads only.

    New key -> inserted at ``now``; payload differs -> replaced, ``ts=now``; same
    payload -> row untouched (old ``ts``); key absent from the batch -> kept.
    A key twice in ``incoming`` raises, or with ``on_duplicate="last"`` the row with the
    greatest payload text is taken (see ``latest_per_key`` for an order). Payloads are
    stored as canonical JSON text, so JSON values are compared, not their spelling; text
    that is not JSON is kept as it is.

    Plan: the batch is joined with the (key, payload fingerprint) pairs of the current table,
    which gives the rows that are new or changed; the current table keeps its rows minus
    their keys (anti-join). Both read one exchange of the batch, so each record is made
    canonical and shuffled once. When few keys change, AQE broadcasts the changed-key set
    and the current table is never shuffled whole. ``current=None`` (first load) inserts the
    batch as is, with no join."""
    incoming = _batch(incoming, key, payload, on_duplicate)
    derive = derive or (lambda rows: rows.select(key, payload, ts))
    if current is None:
        return derive(incoming.select(key, payload, _ts(now).alias(ts)))
    guard_union_partitioning(incoming.sparkSession)
    stored = current.select(key, fingerprint(payload).alias("_cf"))
    # the batch's fingerprint is taken above the join: both uses then share one exchange
    changed = incoming.where(F.col(key).isNotNull()).join(stored, key, "left").where(~F.col("_cf").eqNullSafe(fingerprint(payload)))
    kept = derive(current).join(changed.select(key), key, "left_anti")
    fresh = changed.select(key, payload).dropDuplicates([key])  # once, however often the current table has the key
    return kept.unionByName(derive(fresh.select(key, payload, _ts(now).alias(ts))))


def upsert_bucketed(table: BucketedTable, incoming: DataFrame, now, payload: str = "payload",
                    ts: str = "extracted_at", on_duplicate: str = "error",
                    derive: Callable[[DataFrame], DataFrame] | None = None) -> bool:
    """``upsert_changed`` on a table bucketed by its key, with the commit; whether there was one.

    The batch is written once into buckets like the table's (see ``staged``); the table itself is
    neither shuffled nor sorted: one merge join compares payloads and gives the rows of the
    next version, each in its bucket. A payload that is the stored text is unchanged; others are
    made canonical and compared in the join. A batch that changes nothing commits nothing,
    which a look for the first change tells. A row without a key is taken by the first load
    only, as by ``upsert_changed``."""
    key, current = table.key, table.current()
    if current is None:
        table.commit(upsert_changed(None, incoming, now, key, payload, ts, on_duplicate, derive))
        return True
    derive = derive or (lambda rows: rows)
    current = derive(current)
    batch = (_batch(incoming, key, payload, on_duplicate) if on_duplicate == "last"
             else require_unique(incoming.select(key, payload), key))
    with staged(batch.where(F.col(key).isNotNull()), key, table.buckets) as batch:
        if table.in_place() and _compared(current.select(key, payload), batch, key, payload).where("_moved").isEmpty():
            return False
        rows = _compared(current, batch, key, payload)
        # a payload that stays is NULL here, so that nothing is derived from it again
        fresh = derive(rows.select(key, F.when(F.col("_moved"), F.col("_t")).alias(payload), _ts(now).alias(ts), "_c", "_moved"))
        table.commit(fresh.select(key, *[
            F.when(F.col("_moved"), F.col(c)).otherwise(F.col("_c")[c]).alias(c) for c in current.columns if c != key]), aligned=True)
    return True


def _compared(current: DataFrame, batch: DataFrame, key: str, payload: str) -> DataFrame:
    """``merged`` rows with ``_t``, the batch's payload as it is stored, and ``_moved``, whether it is new
    or changed. CASE makes a payload canonical only where its text is not the stored one."""
    stored, text = F.col("_c")[payload], F.col("_s")[payload]
    rows = merged(current, batch, key).withColumn("_t", F.when(stored.eqNullSafe(text), text).otherwise(_canonical(text)))
    return rows.withColumn("_moved", F.col("_s").isNotNull() & (F.col("_c").isNull() | ~stored.eqNullSafe(F.col("_t"))))


def upsert_replay(changes: DataFrame, key: str, batch_col: str, payload: str = "payload",
                  batch_ts: str | Column | None = None) -> DataFrame:
    """The table after applying every batch in ``batch_col`` order.

    ``changes`` holds at most one row per (key, batch) — pre-aggregate with
    ``latest_per_key``. A row is a change if its payload differs from the row before it,
    found by a two-level scan (see ``scan``), so a key of any size spreads over tasks.
    Result: ``(key, payload, extracted_at)`` where ``extracted_at`` is the batch time
    of the last change, exactly as repeated ``upsert_changed`` calls would leave it."""
    bt = F.col(batch_col) if batch_ts is None else (
        F.col(batch_ts) if isinstance(batch_ts, str) else batch_ts)
    rows = changes.select(F.col(key).alias("_key"), F.col(payload).alias("_payload"), bt.alias("_bt"), F.col(batch_col).alias("_o"))
    return _last_change(rows).select(
        F.col("_key").alias(key), F.col("_r._payload").alias(payload), F.col("_r._bt").alias("extracted_at"))


def _last_change(rows: DataFrame) -> DataFrame:
    """``_key``, ``_r``: payload and time of the key's last change in the order ``_o``, and ``_o``, its
    last place. Partial aggregates over rows marked by the scan."""
    marked = neighbour(blocked(rows, "_key", "_o"), "_key", "_o", ["_payload"], "_prev")
    changed = F.col("_prev").isNull() | ~F.col("_prev._payload").eqNullSafe(F.col("_payload"))
    return marked.groupBy("_key").agg(
        F.max_by(F.struct("_payload", "_bt"), F.when(changed, F.col("_o"))).alias("_r"), F.max("_o").alias("_o"))


def upsert_sequence(current: DataFrame, incoming: DataFrame, order_cols: list[str],
                    now_col: str, key: str = "id", payload: str = "payload",
                    ts: str = "extracted_at") -> DataFrame:
    """Apply several pages of one micro-batch in (page, pos) order, exactly as one
    ``upsert_changed`` per record would: the current table is the first step of each
    key's sequence, every later row counts as a change only if its payload differs from
    the row before it. ``now_col`` on ``incoming`` is each row's load time.

    The result keeps ``_ord``: the (page, pos) of the last record applied per key.
    Records older than that (a page that arrives after a newer one) are dropped, so
    an old page never overwrites a newer payload. Whole numbers in the order are compared as
    bigint; other columns as they are.

    The current order of each incoming key is joined to it, then keys are scanned in two
    levels (see ``scan``): no task holds a key with many rows."""
    def ordered(c: str) -> Column:
        whole = incoming.schema[c].dataType.simpleString() in ("tinyint", "smallint", "int")
        return (F.col(c).cast("bigint") if whole else F.col(c)).alias(c)

    rest = incoming.select(
        F.col(key).alias("_key"), F.col(payload).alias("_payload"), F.col(now_col).cast("timestamp").alias("_bt"),
        F.struct(*[ordered(c) for c in order_cols]).alias("_ord"))
    ord_type = rest.schema["_ord"].dataType
    cur_ord = F.col("_ord") if "_ord" in current.columns else F.lit(None)
    first = current.select(F.col(key).alias("_key"), F.col(payload).alias("_payload"), F.col(ts).alias("_bt"), cur_ord.cast(ord_type.simpleString()).alias("_ord"))
    if "_ord" in current.columns:
        applied = first.select(F.col("_key").alias("_k"), F.col("_ord").alias("_applied")).where("_applied IS NOT NULL")
        rest = rest.join(applied, F.col("_key").eqNullSafe(F.col("_k")), "left").where(
            F.col("_applied").isNull() | (F.col("_ord") > F.col("_applied"))).drop("_k", "_applied")
    seq = first.withColumn("_step", F.lit(0)).unionByName(rest.withColumn("_step", F.lit(1))).select(
        "_key", "_payload", "_bt", F.struct("_step", "_ord").alias("_o"))
    return _last_change(seq).select(
        F.col("_key").alias(key), F.col("_r._payload").alias(payload), F.col("_r._bt").alias(ts), F.col("_o._ord").alias("_ord"))
