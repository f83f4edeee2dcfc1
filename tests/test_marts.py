import datetime as dt

from linkmart.operators.links import unnest_links
from linkmart.operators.marts import dimension, fact
from linkmart.operators.snapshots import scd2_merge
from linkmart.plans.spec import EntitySpec, Link

A = EntitySpec("as", "a", links=(Link("bs", "bs", "bs", "b_url", "b_id"),))
B = EntitySpec("bs", "b")


def _snap(spark, batches):
    snap = None
    for i, rows in enumerate(batches):
        src = spark.createDataFrame(rows, "id string, name string")
        snap = scd2_merge(snap, src, dt.datetime(2024, 1, 1 + i))
    return snap


def test_unnest_keeps_duplicates_and_drops_empty(spark):
    st = spark.createDataFrame(
        [("1", ["https://h/api/bs/g1", "https://h/api/bs/g1", "https://h/g2/"]), ("2", []), ("3", None)],
        "a_id string, bs array<string>")
    got = [tuple(r) for r in unnest_links(st, "a_id", "bs", "b_url", "b_id").collect()]
    assert [g[2] for g in got] == ["g1", "g1", ""] and all(g[0] == "1" for g in got)


def test_fact_versions_and_unmatched(spark):
    da = dimension(_snap(spark, [[("1", "x")], [("1", "y")]]), A)            # 2 versions
    db = dimension(_snap(spark, [[("g", "p")], [("g", "q")], [("g", "r")]]), B)  # 3 versions
    links = spark.createDataFrame([("1", "g"), ("1", "missing")], "a_id string, b_id string")
    lk = A.link("bs")
    all_rows = fact(links, da, A, db, B, lk, "all").where("b_id = 'g'").collect()
    cur_rows = fact(links, da, A, db, B, lk, "current").collect()
    assert len(all_rows) == 6
    cur = {r["b_id"]: r for r in cur_rows}
    assert len(cur_rows) == 2 and cur["g"]["a_name"] == "y" and cur["g"]["b_name"] == "r"
    assert cur["missing"]["b_sk"] is None and cur["missing"]["b_name"] is None
