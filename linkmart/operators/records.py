"""Split page records into good rows and quarantine, and count what was loaded.

Input rows carry one JSON value each as VARIANT (``value``) plus ``source_name``,
``page`` and ``pos`` (see ``linkmart.sources.pages.explode_records``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmart.functions.json_ops import is_truthy, json_kind, variant_field, variant_json

# Quarantine reasons.
NOT_A_DICT = "not_a_dict"
MISSING_ID = "missing_id"
MALFORMED_PAGE = "malformed_page"
UNPARSEABLE_JSON = "unparseable_json"


def _ts(now) -> Column:
    if isinstance(now, Column):
        return now
    if isinstance(now, (dt.datetime, dt.date)):
        return F.lit(now).cast("timestamp")
    return F.lit(str(now)).cast("timestamp")


def label_records(records: DataFrame, key: str = "id") -> DataFrame:
    """Add ``id`` (text of a truthy id), canonical ``payload`` text and ``reason``
    (NULL for good rows, else ``unparseable_json`` / ``not_a_dict`` / ``missing_id``). A
    record that did not parse has a NULL ``value`` and its ``text``, which is its payload."""
    text = F.col("text") if "text" in records.columns else F.lit(None).cast("string")
    v = F.col("value")
    is_obj = json_kind(v) == "object"
    id_v = variant_field(v, key)
    good = is_obj & is_truthy(id_v)
    return records.select(
        "*",
        F.when(good, F.regexp_replace(F.try_variant_get(id_v, "$", "string"), "^\ue000#", "")).alias("id"),
        F.coalesce(variant_json(v), text).alias("payload"),
        F.when(v.isNull() & text.isNotNull(), F.lit(UNPARSEABLE_JSON))
        .when(~is_obj | v.isNull(), F.lit(NOT_A_DICT))
        .when(~is_truthy(id_v), F.lit(MISSING_ID))
        .alias("reason"),
    ).drop("value", "text")


def split_records(records: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(good, bad) from one labelled plan. Persist or checkpoint ``records`` first when
    both sides are consumed, so the pages are read once."""
    labelled = label_records(records, key)
    good = labelled.where(F.col("reason").isNull()).drop("reason")
    bad = labelled.where(F.col("reason").isNotNull())
    return good, bad


def quarantine(bad: DataFrame, now, batch: str | Column = "") -> DataFrame:
    """Quarantine rows ``(raw_id, source_name, raw_payload, reason, extracted_at)``.

    ``raw_id`` = md5 of (source, batch, page, pos), so replaying a batch appends nothing
    new after an anti-join on ``raw_id`` (see ``append_new``). ``batch`` names the load the
    row came from: the same place of a page that is loaded again is another row."""
    from linkmart.functions.scalars import surrogate_key

    b = batch if isinstance(batch, Column) else F.lit(batch)
    return bad.select(
        surrogate_key(F.col("source_name"), b, F.col("page"), F.col("pos")).alias("raw_id"),
        "source_name",
        F.col("payload").alias("raw_payload"),
        "reason",
        _ts(now).alias("extracted_at"),
    )


def append_new(existing: DataFrame, fresh: DataFrame, key: str = "raw_id") -> DataFrame:
    """Rows of ``fresh`` whose key is not yet in ``existing`` (idempotent append)."""
    return fresh.join(existing.select(key).distinct(), key, "left_anti")


def running_total(df: DataFrame, group: str, order: str, value: str, out: str,
                  block: int = 4096) -> DataFrame:
    """``out`` = running sum of ``value`` over ``order`` within ``group``, without a
    window over a whole group (one group may hold a third of all rows).

    Two levels: rows are cut into blocks of ``block`` consecutive ``order`` values; the
    running sum over the per-block totals (one row per block) gives each block's offset,
    and a window over (group, block) adds the running sum inside the block. Every window
    holds at most ``block`` rows, or one row per block. ``order`` must be integral."""
    blk = F.floor(F.col(order) / block)
    with_blk = df.withColumn("_blk", blk)
    totals = with_blk.groupBy(group, "_blk").agg(F.sum(value).alias("_bt"))
    w_blocks = Window.partitionBy(group).orderBy("_blk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(group, "_blk",
                            F.coalesce(F.sum("_bt").over(w_blocks), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy(group, "_blk").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        with_blk.join(offsets, [group, "_blk"], "left")
        .withColumn(out, (F.col("_off") + F.sum(value).over(w_in)).cast("long"))
        .drop("_blk", "_off")
    )


def load_metrics(labelled: DataFrame) -> DataFrame:
    """Per (source, page): loaded (good) and quarantined counts, records seen, and the
    running loaded total in page order (see ``running_total``)."""
    per_page = labelled.groupBy("source_name", "page").agg(
        F.count_if(F.col("reason").isNull()).alias("loaded"),
        F.count_if(F.col("reason").isNotNull()).alias("quarantined"),
        F.count(F.lit(1)).alias("records"),
    )
    return running_total(per_page, "source_name", "page", "loaded", "loaded_total")
