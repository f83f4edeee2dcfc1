"""Plan-shaping helper for filters on computed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_computed(df: DataFrame, predicate: Column | str) -> DataFrame:
    """``df.where(predicate)`` for a predicate over columns ``df`` computes from
    expensive expressions (a JSON parse), evaluated once per row.

    A plain filter is pushed below the projection with each referenced column replaced by
    its expression, so the parse runs in the filter and again in the projection. Rows
    pass through a one-element ``inline_outer`` first: a predicate on generated columns
    cannot move below the generator, and the outer form infers no pre-filter."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.select(F.inline_outer(F.array(F.struct(*cols)))).where(pred)
