"""The payload parsed once: a struct column ``parsed`` beside it.

``parsed`` holds every field that the entity's spec reads, typed as its readers need it: texts,
sub-JSON, link arrays and their JSON kind. The raw layer stores it with the row, computed
when a payload is inserted or changed, so staging, snapshots, dead letters and checks read
single columns of it and nothing parses a payload again.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmart.functions.json_ops import as_variant, json_array_text, json_kind, json_text, json_value, variant_field
from linkmart.plans.spec import EntitySpec

PARSED = "parsed"


def text_field(key: str) -> str:
    return f"text__{key}"


def json_field(key: str) -> str:
    return f"json__{key}"


def links_field(key: str) -> str:
    return f"links__{key}"


def kind_field(key: str) -> str:
    return f"kind__{key}"


def _fields(spec: EntitySpec) -> Iterator[tuple[str, object]]:
    snapshot = spec.snapshot_columns()
    texts = [spec.key, spec.name_key, *spec.required, *(a.key for a in spec.attrs if a.kind != "json"),
             *(k for k, kind in snapshot if kind != "json")]
    jsons = [*(a.key for a in spec.attrs if a.kind == "json"), *(k for k, kind in snapshot if kind == "json")]
    for k in dict.fromkeys(texts):
        yield text_field(k), lambda v, k=k: json_text(v, k)
    for k in dict.fromkeys(jsons):
        yield json_field(k), lambda v, k=k: json_value(v, k)
    for k in dict.fromkeys(lk.key for lk in spec.links):
        yield links_field(k), lambda v, k=k: json_array_text(v, k)
        yield kind_field(k), lambda v, k=k: json_kind(variant_field(v, k))


def with_parsed(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """``raw(..., payload)`` with ``parsed``; rows that have the spec's fields already keep theirs,
    those of another spec version are parsed again."""
    fields = list(_fields(spec))
    if PARSED in raw.columns:
        if raw.schema[PARSED].dataType.names == [name for name, _ in fields]:
            return raw
        raw = raw.drop(PARSED)
    parsed = raw.select("*", as_variant(F.col("payload")).alias("_v"))
    return parsed.select(*[F.col(f"`{c}`") for c in raw.columns], F.struct(*[f(F.col("_v")).alias(n) for n, f in fields]).alias(PARSED))


def field(name: str) -> Column:
    return F.col(PARSED)[name]
