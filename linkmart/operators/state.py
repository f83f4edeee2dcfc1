"""Extraction state per source: partial keyed updates and the resume rule. The state
itself is written by ``plans/extract.py`` and ``streaming/ingest.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

STATE_SCHEMA = StructType([
    StructField("source_name", StringType(), False),
    StructField("status", StringType(), False),
    StructField("last_completed_page", IntegerType(), True),
    StructField("run_started_at", TimestampType(), True),
    StructField("run_ended_at", TimestampType(), True),
    StructField("error_message", StringType(), True),
    StructField("records_loaded", IntegerType(), False),
])
STATE_COLUMNS = [f.name for f in STATE_SCHEMA.fields]

# State statuses.
IN_PROGRESS, FAILED, COMPLETED = "in_progress", "failed", "completed"


def merge_state(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert by ``source_name``. Columns present in ``updates`` replace the stored
    value outright on a match (an explicit NULL overwrites); absent columns are kept.
    New sources get NULL for absent columns and 0 for ``records_loaded``."""
    supplied = [c for c in updates.columns if c != "source_name"]
    u = updates.select("source_name", *[F.col(c).alias(f"_u_{c}") for c in supplied],
                       F.lit(True).alias("_hit"))
    j = state.join(u, "source_name", "full_outer")
    out = []
    for c in STATE_COLUMNS[1:]:
        if c in supplied:
            val = F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c))
        else:
            val = F.col(c)
        if c == "records_loaded":
            val = F.coalesce(val, F.lit(0))
        out.append(val.cast(STATE_SCHEMA[c].dataType).alias(c))
    return j.select("source_name", *out)


def read_state(state: DataFrame, source_name: str) -> DataFrame:
    """Status, last completed page and records loaded of one source (0 or 1 row)."""
    return state.where(F.col("source_name") == source_name).select(
        "status", "last_completed_page", "records_loaded")


def resume_point(state: DataFrame) -> DataFrame:
    """``source_name, start_page, records_loaded``: an interrupted or failed run resumes
    after its last completed page (none -> 0) and keeps its count; otherwise start at 0.
    (A last page of 0 resumes at 1: page 0 is not reloaded and double counted.)"""
    resumable = F.col("status").isin(IN_PROGRESS, FAILED)
    return state.select(
        "source_name",
        F.when(resumable, F.coalesce(F.col("last_completed_page"), F.lit(-1)) + 1)
        .otherwise(F.lit(0)).cast("int").alias("start_page"),
        F.when(resumable, F.col("records_loaded")).otherwise(F.lit(0)).cast("int")
        .alias("records_loaded"),
    )
