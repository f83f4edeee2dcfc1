"""The refresh job: ingest -> snapshot -> models -> dead letters -> checks.

Layers live under one folder:
  raw/<entity>/v=N        keyed raw tables (versioned; upserted each run), each row with the
                          fields parsed from its payload, which all later layers read
  snapshots/<entity>/     type-2 history: append-only closed versions + versioned
                          current slice (see SnapshotStore); a run never rewrites history
  marts/<table>           dimensions and facts, rebuilt each run
  intermediate/dead_letters, checks/report
Staging and link models stay lazy (views). Every written table is read back before
use, which also cuts the lineage between layers.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.operators.checks import Check, check_report, spec_checks
from linkmart.operators.deadletters import dead_letters
from linkmart.operators.marts import fact
from linkmart.operators.records import _ts
from linkmart.operators.shred import with_parsed
from linkmart.operators.snapshots import scd2_bucketed, scd2_step, snapshot_source
from linkmart.operators.upsert import latest_per_key, upsert_bucketed, upsert_changed
from linkmart.plans.extract import extract, mark_applied, store_quarantine, stored_quarantine
from linkmart.plans.models import build_models
from linkmart.plans.spec import Catalog, EntitySpec
from linkmart.session import spare_disk
from linkmart.sources.buckets import BucketedSnapshotStore, BucketedTable
from linkmart.sources.tables import SnapshotStore, VersionedTable


def _commit_and_read(table: VersionedTable, df: DataFrame) -> DataFrame:
    n = table.commit(df)
    return table.spark.read.parquet(table.path(n))


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def generated_checks(catalog: Catalog, models) -> list[Check]:
    checks: list[Check] = []
    for spec in catalog.entities:
        if spec.name in models.staged and spec.name in models.dims:
            checks += spec_checks(spec, f"stg_{spec.name}", f"dim_{spec.name}")
    for f in catalog.facts:
        if f.name not in models.facts:
            continue
        left = catalog.entity(f.entity)
        lk = left.link(f.link)
        right = catalog.entity(lk.target)
        checks += [
            Check(f.name, "not_null", left.id_col),
            Check(f.name, "relationships", left.id_col, f"dim_{left.name}", left.id_col),
            Check(f.name, "not_null", lk.id_col),
            Check(f.name, "relationships", lk.id_col, f"dim_{right.name}", right.id_col),
        ]
    checks.append(Check("dead_letters", "count",
                        predicate="error_type in ('missing_id', 'not_a_dict')"))
    return checks


def parallel(fn, items, workers: int = 4) -> list:
    """Run independent per-entity/per-table Spark jobs from a few driver threads, so
    small jobs overlap on the cluster instead of queueing one after the other."""
    items = list(items)
    if len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(workers, len(items))) as pool:
        return list(pool.map(fn, items))


def take_snapshot(spark: SparkSession, spec: EntitySpec, raw: DataFrame, out_dir: str, now,
                  buckets: int | None = None) -> SnapshotStore:
    """Merge a raw table into its entity's snapshot store, committed; returns the store."""
    path, source = f"{out_dir.rstrip('/')}/snapshots/{spec.name}", snapshot_source(raw, spec)
    store = BucketedSnapshotStore(spark, path, spec.key, buckets) if buckets else SnapshotStore(spark, path)
    closed, current_next = (scd2_bucketed if buckets else scd2_step)(store.current(), source, now, spec.key)
    store.commit(closed, current_next, now)
    return store


def ingest_and_snapshot(spark: SparkSession, catalog: Catalog, incoming: dict, out_dir: str,
                        now, snapshots: bool = True, keep_versions: int | None = None,
                        on_duplicate: str = "error", buckets: int | None = None) -> tuple[dict, dict]:
    """The raw and snapshot layers of one run: upsert each entity's batch into its
    versioned raw table, then merge the raw table into its snapshot store. Both are
    committed and read back (``snapshots=False`` stops after the raw layer). Entities
    are independent and processed concurrently. ``keep_versions`` vacuums older
    versions after the commit. With ``buckets`` the raw tables and current slices are
    bucketed by key (see ``sources/buckets.py``), so a run shuffles its batch, not the tables.
    Returns (raw, snapshots) by name."""
    out = out_dir.rstrip("/")

    def one(spec):
        path = f"{out}/raw/{spec.name}"
        table = BucketedTable(spark, path, "id", buckets) if buckets else VersionedTable(spark, path)
        current = VersionedTable.current(table)
        if spec.name in incoming:
            batch = incoming[spec.name].withColumn("id", F.trim("id"))
            if "_order" in batch.columns:
                batch = latest_per_key(batch, "id", ["_order"], "last")
            batch, derive = batch.select("id", "payload"), lambda rows: with_parsed(rows, spec)
            if buckets:
                upsert_bucketed(table, batch, now, on_duplicate=on_duplicate, derive=derive)
                current = VersionedTable.current(table)
            else:
                current = _commit_and_read(table, upsert_changed(current, batch, now, on_duplicate=on_duplicate, derive=derive))
            if keep_versions:
                table.vacuum(keep_versions)
        if current is None or not snapshots:
            return spec.name, current, None
        store = take_snapshot(spark, spec, current, out, now, buckets)
        if keep_versions:
            store.current_table.vacuum(keep_versions)
        return spec.name, current, store.snapshot()

    raw, snaps = {}, {}
    for name, r, snap in parallel(one, catalog.entities):
        if r is not None:
            raw[name] = r
        if snap is not None:
            snaps[name] = snap
    return raw, snaps


def _sparing(run):
    """``run(spark, ...)`` with the disk spared (see ``spare_disk``)."""
    @wraps(run)
    def sparing(spark: SparkSession, *args, **kwargs):
        with spare_disk(spark):
            return run(spark, *args, **kwargs)

    return sparing


@_sparing
def refresh(spark: SparkSession, catalog: Catalog, incoming: dict, out_dir: str, now,
            quarantine: DataFrame | None = None, keep_versions: int | None = None,
            on_duplicate: str = "error", buckets: int | None = None) -> dict[str, DataFrame]:
    """One run at ``now``. ``incoming`` maps entity name -> records ``(id, payload)``
    (one batch; ids are trimmed; with an ``_order`` column the row of the greatest order
    wins, else an id twice raises, or with ``on_duplicate="last"`` the greatest payload
    wins). ``keep_versions`` keeps only that many raw / current-slice versions, ``buckets`` is
    the number of buckets of those tables (None: not bucketed).
    ``quarantine`` rows are stored under ``<out_dir>/quarantine``, and the dead letters show
    those of all runs. Returns the written tables, read back."""
    out = out_dir.rstrip("/")
    raw, snaps = ingest_and_snapshot(spark, catalog, incoming, out, now,
                                     keep_versions=keep_versions, on_duplicate=on_duplicate, buckets=buckets)
    models = build_models(catalog, raw, snaps)
    written: dict[str, DataFrame] = {}
    dims = parallel(lambda kv: (kv[0], _write(kv[1], f"{out}/marts/dim_{kv[0]}")),
                     models.dims.items())
    written.update({f"dim_{k}": v for k, v in dims})
    models.dims = {k: written[f"dim_{k}"] for k in models.dims}
    # facts over the written dimensions, and dead letters, written concurrently
    jobs = []
    for f in catalog.facts:
        left = catalog.entity(f.entity)
        lk = left.link(f.link)
        right = catalog.entity(lk.target)
        key = (f.entity, f.link)
        if key in models.links and f.entity in models.dims and right.name in models.dims:
            jobs.append((f.name, f"{out}/marts/{f.name}", fact(
                models.links[key], models.dims[f.entity], left, models.dims[right.name],
                right, lk, f.versions, f.left_extras, f.right_extras)))
    if quarantine is not None:
        store_quarantine(spark, out, quarantine, uuid.uuid4().hex)
    quarantine = stored_quarantine(spark, out)  # of this and of earlier runs
    jobs.append(("dead_letters", f"{out}/intermediate/dead_letters",
                 dead_letters(raw, catalog.entities, quarantine)))
    for name, df in parallel(lambda j: (j[0], _write(j[2], j[1])), jobs):
        written[name] = df
    models.facts = {k: v for k, v in written.items()
                    if not k.startswith("dim_") and k != "dead_letters"}

    tables = dict(models.tables())
    tables.update(written)
    for spec in catalog.entities:
        if f"dim_{spec.name}" in tables:
            tables[f"dim_{spec.name}__current"] = tables[f"dim_{spec.name}"].where("is_current")
    report = check_report(generated_checks(catalog, models), tables)
    written["checks"] = _write(report.withColumn("checked_at", _ts(now)), f"{out}/checks/report")
    return written


def extract_and_refresh(spark: SparkSession, catalog: Catalog, pages_path: str, out_dir: str, started, now,
                        keep_versions: int | None = None, source_order: list[str] | None = None,
                        buckets: int | None = None) -> dict[str, DataFrame]:
    """One run over landed pages: an extraction (see ``plans/extract.py``), the refresh of what it
    handed out, and only then its mark as applied. If the refresh fails, the next run is
    handed the same batches again."""
    incoming = extract(spark, pages_path, out_dir, started, now, source_order=source_order)
    known = {e.name for e in catalog.entities}
    written = refresh(spark, catalog, {k: v for k, v in incoming.items() if k in known}, out_dir, now,
                      keep_versions=keep_versions, buckets=buckets)
    mark_applied(spark, out_dir)
    return written


def refresh_from_stream(spark: SparkSession, catalog: Catalog, stream_dir: str, out_dir: str, now,
                        keep_versions: int | None = None, buckets: int | None = None) -> dict[str, DataFrame]:
    """One run over what a file stream has ingested: its keyed raw tables (base and the epochs
    since) are the batch, of which the upsert takes what has changed, and its quarantine."""
    from linkmart.streaming.ingest import quarantine_table, raw_table, stream_sources

    known = {e.name for e in catalog.entities}
    incoming = {s: raw_table(spark, stream_dir, s).select("id", "payload") for s in stream_sources(spark, stream_dir) if s in known}
    return refresh(spark, catalog, incoming, out_dir, now, quarantine_table(spark, stream_dir), keep_versions, buckets=buckets)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows`` for each table (one small aggregate per table)."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in sorted(tables.items())]
    return reduce(lambda a, b: a.unionByName(b), parts)
