import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from linkmart.operators.snapshots import scd2_merge, scd2_replay


def _src(spark, rows):
    return spark.createDataFrame(rows, "id string, v string")


def _run(spark, batches):
    snap = None
    for i, rows in enumerate(batches):
        snap = scd2_merge(snap, _src(spark, rows), dt.datetime(2024, 1, 1 + i))
    return snap


def _check_intervals(rows):
    by_id = {}
    for r in rows:
        by_id.setdefault(r["id"], []).append(r)
    for vs in by_id.values():
        vs.sort(key=lambda r: r["valid_from"])
        assert sum(r["valid_to"] is None for r in vs) == 1
        for a, b in zip(vs, vs[1:]):
            assert a["valid_to"] == b["valid_from"]


def test_history_cases(spark):
    snap = _run(spark, [[("1", "a"), ("2", None), ("3", None), ("4", "x"), ("5", "k")],
                        [("1", "a"), ("2", None), ("3", "x"), ("4", None)],
                        [("1", "b")],
                        [("1", "a")]])
    rows = snap.collect()
    n = {}
    for r in rows:
        n[r["id"]] = n.get(r["id"], 0) + 1
    assert n == {"1": 3, "2": 1, "3": 2, "4": 2, "5": 1}
    _check_intervals(rows)
    five = [r for r in rows if r["id"] == "5"][0]
    assert five["valid_to"] is None  # missing from later runs: stays current


def test_merge_is_idempotent(spark):
    s1 = scd2_merge(None, _src(spark, [("1", "a")]), dt.datetime(2024, 1, 1))
    s2 = scd2_merge(s1, _src(spark, [("1", "a")]), dt.datetime(2024, 1, 2))
    assert sorted(map(tuple, s1.collect()), key=repr) == sorted(map(tuple, s2.collect()), key=repr)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from("pq"), st.sampled_from(["x", "y", None]),
                                min_size=1, max_size=2), min_size=1, max_size=4))
def test_merge_fold_equals_replay(spark, batches):
    rows_b = [list(b.items()) for b in batches]
    folded = sorted(map(tuple, _run(spark, rows_b).collect()), key=repr)
    flat = [(k, v, dt.datetime(2024, 1, 1 + i)) for i, b in enumerate(rows_b) for k, v in b]
    ch = spark.createDataFrame(flat, "id string, v string, day timestamp")
    replay = scd2_replay(ch, "id", "day", ["v"])
    assert sorted(map(tuple, replay.select("id", "v", "scd_id", "updated_at", "valid_from",
                                           "valid_to").collect()), key=repr) == folded


def test_snapshot_store_rerun_appends_nothing_twice(spark, scratch):
    from linkmart.operators.snapshots import scd2_step
    from linkmart.sources.tables import SnapshotStore

    store = SnapshotStore(spark, scratch("snap"))
    runs = [[("1", "a"), ("2", "x")], [("1", "b"), ("2", "x")], [("1", "c")]]
    for i, rows in enumerate(runs):
        now = dt.datetime(2024, 1, 1 + i)
        closed, nxt = scd2_step(store.current(), _src(spark, rows), now)
        store.commit(closed, nxt, now)
        if i == 1:  # the same run again (e.g. retried after a failure): history unchanged
            before = store.history().count()
            store.current_table.commit(store.current())  # no-op version
            closed2, _ = scd2_step(
                spark.read.parquet(store.current_table.path(store.current_table.versions()[-2])),
                _src(spark, rows), now)
            store.commit(closed2, store.current(), now)
            assert store.history().count() == before
    snap = store.snapshot()
    expected = _run(spark, runs)
    assert sorted(map(tuple, snap.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
