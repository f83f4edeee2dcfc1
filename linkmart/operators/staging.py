"""Typed, trimmed columns out of the raw payload's parsed fields (see ``shred``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmart.functions.scalars import parse_long_date
from linkmart.operators.shred import field, json_field, links_field, text_field, with_parsed
from linkmart.plans.spec import EntitySpec


def stage(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """``raw(id, payload, extracted_at)`` -> ``<p>_id, <p>_name, attrs..., links...,
    extracted_at``. Text is space-trimmed; dates parsed from long form; link arrays as
    ``array<string>`` (JSON null / non-array -> NULL)."""
    cols = [
        F.trim(field(text_field(spec.key))).alias(spec.id_col),
        F.trim(field(text_field(spec.name_key))).alias(spec.name_col),
    ]
    for a in spec.attrs:
        name = a.staged or a.key
        if a.kind == "date":
            cols.append(parse_long_date(field(text_field(a.key))).alias(name))
        elif a.kind == "json":
            cols.append(field(json_field(a.key)).alias(name))
        else:
            cols.append(F.trim(field(text_field(a.key))).alias(name))
    for lk in spec.links:
        cols.append(field(links_field(lk.key)).alias(lk.staged))
    cols.append(F.col("extracted_at").cast("timestamp").alias("extracted_at"))
    return with_parsed(raw, spec).select(*cols)
