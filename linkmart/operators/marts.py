"""Dimensions over snapshots and factless bridge facts over link rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmart.functions.scalars import parse_long_date
from linkmart.plans.spec import EntitySpec, Link


def dimension(snapshot: DataFrame, spec: EntitySpec) -> DataFrame:
    """Every version of every entity: ``<p>_sk, <p>_id, <p>_name, attrs...,
    valid_from, valid_to, is_current``."""
    cols = [
        F.col("scd_id").alias(spec.sk_col),
        F.col(spec.key).alias(spec.id_col),
        F.col(spec.name_key).alias(spec.name_col),
    ]
    for a in spec.attrs:
        if not a.dim:
            continue
        src = F.col(a.key)
        cols.append((parse_long_date(src) if a.kind == "date" else src).alias(a.dim))
    cols += [
        F.col("valid_from"),
        F.col("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    ]
    return snapshot.select(*cols)


def _side(dim: DataFrame, spec: EntitySpec, key_alias: str, extras, current: bool):
    d = dim.where(F.col("is_current")) if current else dim
    return d.select(
        F.col(spec.sk_col), F.col(spec.id_col).alias(key_alias), F.col(spec.name_col),
        *[F.col(e) for e in extras],
    )


def fact(links: DataFrame, left_dim: DataFrame, left: EntitySpec, right_dim: DataFrame,
         right: EntitySpec, link: Link, versions: str = "current",
         left_extras=(), right_extras=()) -> DataFrame:
    """Link rows LEFT JOIN both dimensions.

    ``versions="current"`` joins only current versions (the filter sits on the
    null-supplying side, so it is applied before the join); ``"all"`` joins every
    version and fans out by design. Unmatched links keep NULL sk and name. Dimensions
    are projected to the joined columns first; AQE decides broadcast vs shuffle from
    their runtime size and splits skewed keys."""
    if versions not in ("current", "all"):
        raise ValueError("versions must be 'current' or 'all'")
    cur = versions == "current"
    lsd = _side(left_dim, left, "_lk", left_extras, cur)
    rsd = _side(right_dim, right, "_rk", right_extras, cur)
    f = links.select(F.col(left.id_col).alias("_lid"), F.col(link.id_col).alias("_rid"))
    j = (
        f.join(lsd, f["_lid"] == lsd["_lk"], "left")
        .join(rsd, f["_rid"] == rsd["_rk"], "left")
    )
    return j.select(
        F.col(left.sk_col), F.col("_lid").alias(left.id_col), F.col(left.name_col),
        *[F.col(e) for e in left_extras],
        F.col(right.sk_col), F.col("_rid").alias(link.id_col), F.col(right.name_col),
        *[F.col(e) for e in right_extras],
    )
