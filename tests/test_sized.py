"""Tasks of the layers and of the check report are bounded by rows and bytes, whatever the session has."""

import re

import pytest
from pyspark.sql import functions as F

from linkmart import session
from linkmart.plans import testbed_queries as q
from linkmart.plans import warehouse_queries as w

PARTS, ADVISORY, SPLIT = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"


def _tables(spark, sf, n=60):
    ids = spark.range(1, n + 1)

    def write(name, *cols):
        ids.select(*[F.expr(c) for c in cols]).write.parquet(f"{sf}/{name}.parquet")

    write("part", "id AS p_partkey", "'p' AS p_name", "'b' AS p_brand", "'t' AS p_type", "CAST(id AS INT) AS p_size")
    write("supplier", "id AS s_suppkey", "'s' AS s_name")
    write("customer", "id AS c_custkey", "'c' AS c_name", "'M' AS c_mktsegment")
    write("orders", "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "DATE '1996-01-02' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    return sf


def _key_partitions(df):
    """Partitions that the tags of a report are dealt to by (check, key)."""
    return int(re.search(r"hashpartitioning\(no#\d+, value#\d+, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())[1])


def test_a_sized_session_asks_for_more_and_keeps_the_rest(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    before, ansi = spark.conf.getAll, "spark.sql.ansi.enabled"
    own = session.sized_session(spark, 95)
    assert (own.conf.get(PARTS), own.conf.get(ADVISORY), own.conf.get(SPLIT)) == ("10", "8m", "32m")
    assert spark.conf.getAll == before and own.conf.get("spark.sql.session.timeZone") == "UTC"
    was = spark.conf.get(ansi)
    try:  # what the caller asks for later holds too: more partitions, smaller ones, other settings
        for k, v in ((PARTS, "12"), (ADVISORY, "1m"), (SPLIT, "64m"), (ansi, "false")):
            spark.conf.set(k, v)
        assert session.sized_session(spark, 95, own) is own
        assert [own.conf.get(k) for k in (PARTS, ADVISORY, SPLIT, ansi)] == ["12", "1m", "32m", "false"]
    finally:
        spark.conf.set(PARTS, before[PARTS])
        spark.conf.unset(ADVISORY)
        spark.conf.unset(SPLIT)
        spark.conf.set(ansi, was)


@pytest.mark.parametrize("query, rows", [(w.warehouse_checks, 480), (q.check_report_q, 120)])
def test_the_keys_of_a_report_go_to_partitions_by_the_rows(spark, tmp_path, monkeypatch, query, rows):
    # before: as many as the session has (8), however large the tables
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    report = query(spark, _tables(spark, str(tmp_path)))
    assert _key_partitions(report) == rows // 10
    found = {r["check_name"]: r["failures"] for r in report.collect()}
    if query is w.warehouse_checks:
        # of 60 monsters the dangling link of each 11th and the link with a slash of each 13th
        # (two versions of the 33rd and 39th; an id is empty, not NULL, behind a slash)
        assert found["relationships__fct_monster_appearances__game_id__dim_games__game_id"] == 11
        assert len(found) == 101
    assert found["unique__dim_orders__order_sk" if query is q.check_report_q else "unique__dim_games__game_sk"] == 0
