import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from linkmart.operators.upsert import (
    DuplicateKeyError, latest_per_key, upsert_changed, upsert_replay, upsert_sequence,
)

T0, T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def _raw(spark, rows):
    return spark.createDataFrame(rows, "id string, payload string, extracted_at timestamp")


def _inc(spark, rows):
    return spark.createDataFrame(rows, "id string, payload string")


def _d(s):
    return dt.datetime.fromisoformat(s)


def test_upsert_cases(spark):
    cur = _raw(spark, [("1", '{"a":1,"id":"1"}', _d(T0)), ("2", '{"id":"2"}', _d(T0)),
                       ("3", '{"id":"3"}', _d(T0))])
    inc = _inc(spark, [("1", '{"a":1,"id":"1"}'), ("2", '{"id":"2","x":1}'), ("4", '{"id":"4"}')])
    got = {r["id"]: (r["payload"], r["extracted_at"]) for r in upsert_changed(cur, inc, T1).collect()}
    assert got["1"] == ('{"a":1,"id":"1"}', _d(T0))          # unchanged keeps old time
    assert got["2"] == ('{"id":"2","x":1}', _d(T1))          # changed
    assert got["3"] == ('{"id":"3"}', _d(T0))                # absent from batch: kept
    assert got["4"] == ('{"id":"4"}', _d(T1))                # new


def test_upsert_idempotent(spark):
    cur = _raw(spark, [("1", "a", _d(T0))])
    inc = _inc(spark, [("1", "b"), ("2", "c")])
    once = upsert_changed(cur, inc, T1)
    twice = upsert_changed(once, inc, T2)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_duplicate_policy(spark):
    df = spark.createDataFrame([("1", "a", 0, 0), ("1", "b", 0, 3), ("2", "c", 0, 1)],
                               "id string, payload string, page int, pos int")
    with pytest.raises(DuplicateKeyError):
        latest_per_key(df, "id", ["page", "pos"], on_duplicate="error")
    got = {r["id"]: r["payload"] for r in latest_per_key(df, "id", ["page", "pos"], "last").collect()}
    assert got == {"1": "b", "2": "c"}


def _fold(spark, batches):
    cur = _raw(spark, [])
    for i, rows in enumerate(batches):
        cur = upsert_changed(cur, _inc(spark, rows), dt.datetime(2024, 1, 1 + i))
    return sorted(map(tuple, cur.collect()), key=repr)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from("abc"), st.sampled_from("xy"), max_size=3),
                min_size=1, max_size=4))
def test_replay_equals_fold(spark, batches):
    rows_b = [list(b.items()) for b in batches]
    folded = _fold(spark, rows_b)
    flat = [(k, v, i, dt.datetime(2024, 1, 1 + i)) for i, b in enumerate(rows_b) for k, v in b]
    ch = spark.createDataFrame(flat, "id string, payload string, b int, ts timestamp")
    replay = upsert_replay(ch, "id", "b", batch_ts="ts") if flat else None
    got = sorted(map(tuple, replay.collect()), key=repr) if replay is not None else []
    assert got == folded


def test_sequence_equals_per_record_upserts(spark):
    # a -> b -> a inside one micro-batch: changed twice, last time wins
    cur = _raw(spark, [("1", "a", _d(T0)), ("2", "z", _d(T0))])
    inc = spark.createDataFrame(
        [("1", "b", 0, 0, _d(T1)), ("1", "a", 1, 0, _d(T2)), ("2", "z", 0, 1, _d(T1)),
         ("3", "n", 1, 1, _d(T2))],
        "id string, payload string, page int, pos int, now timestamp")
    got = {r["id"]: (r["payload"], r["extracted_at"])
           for r in upsert_sequence(cur, inc, ["page", "pos"], "now").collect()}
    assert got == {"1": ("a", _d(T2)), "2": ("z", _d(T0)), "3": ("n", _d(T2))}


def test_an_upsert_reads_its_batch_once(spark, scratch):
    # before: the batch was read, made canonical and shuffled twice, for its fingerprints and for its rows
    cur = upsert_changed(None, spark.range(100).selectExpr("cast(id as string) id", """concat('{"n":', id, '}') payload"""), T0)
    cur.unionByName(cur.where("id = '7'")).write.parquet(cp := scratch("cur"))  # a key that the table has twice is replaced once
    inc = spark.range(100).selectExpr("cast(nullif(id, 3) as string) id", """concat('{ "n":', if(id % 7 = 0, -id, id), '}') payload""")
    inc.write.parquet(ip := scratch("inc"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = upsert_changed(spark.read.parquet(cp), spark.read.parquet(ip), T1)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("FileScan parquet") == 3  # the table's pairs, its rows, the batch
    got = {r["id"]: (r["payload"], r["extracted_at"]) for r in rows}
    assert len(rows) == len(got) == 100 and got["3"] == ('{"n":3}', _d(T0))
    assert got["7"] == ('{"n":-7}', _d(T1)) and got["8"] == ('{"n":8}', _d(T0))
