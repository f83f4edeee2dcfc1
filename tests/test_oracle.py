"""Every registered query against its oracle SQL on the smallest tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

SF = os.environ.get("LINKMART_TEST_SF", "/root/testdata/sf0.001")

import __spark_entry__ as E  # noqa: E402
from check_oracle import duck, frame_digest  # noqa: E402
from linkmart.plans.testbed_queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle")
    odf = con.execute(sql).df()
    sc, sn, sh, _ = frame_digest(sdf)
    oc, on, oh, _ = frame_digest(odf)
    assert (sc, sn) == (oc, on)
    assert sh == oh


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "order_sk" in df.columns


@pytest.mark.parametrize("name", ["stream_upsert", "dim_orders_all", "scd2_replay_events",
                                  "surrogate_key_events", "refresh_counts"])
def test_query_matches_oracle_in_another_time_zone(spark, con, name):
    """Results are wall-clock values: a non-UTC session gives the same rows."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sdf = E.queries()[name](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    odf = con.execute(E.oracle_sql()[name]).df()
    assert frame_digest(sdf)[:3] == frame_digest(odf)[:3]


def test_every_query_has_an_oracle_with_the_same_columns(spark, con):
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    for name in ("fact_current", "dead_letters", "check_report", "state_after_run"):
        spark_cols = sorted(E.queries()[name](spark, SF).columns)
        oracle_cols = sorted(con.sql(E.oracle_sql()[name]).columns)
        assert spark_cols == oracle_cols, name
