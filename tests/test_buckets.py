"""Bucketed raw tables and current slices: same rows as the plain ones, no exchange over what is stored."""

import re

import pytest
from pyspark.sql import functions as F

from linkmart.operators.snapshots import META, scd2_bucketed, scd2_step
from linkmart.operators.upsert import DuplicateKeyError, changed_keys, upsert_bucketed, upsert_changed
from linkmart.sources.buckets import BucketedSnapshotStore, BucketedTable, merged
from linkmart.sources.tables import SnapshotStore, VersionedTable

T = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]


def records(spark, rows):
    return spark.createDataFrame(rows, "id string, payload string")


def batch(spark, n, changed, start=0):
    return records(spark, [(str(i), f'{{"id":"{i}","v":{int(i in changed)}}}') for i in range(start, n)])


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.select(sorted(df.columns)).collect())))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def leaves_under_exchange(plan, table_path):
    """Whether a scan of ``table_path`` lies below an Exchange or Sort of the plan's tree."""
    stack, hits = [], []
    for line in plan.splitlines():
        m = re.match(r"^([\s:+\-|*(0-9)]*)(\w+)", line)
        if not m:
            continue
        depth, op = len(m.group(1).replace("*", " ").split("(")[0]), m.group(2)
        while stack and stack[-1][0] >= depth:
            stack.pop()
        if op == "FileScan" and table_path in line:
            hits.append([o for _, o in stack if o in ("Exchange", "Sort", "BroadcastExchange")])
        stack.append((depth, op))
    return hits


def test_same_table_as_the_plain_upsert(spark, scratch):
    table, plain = BucketedTable(spark, scratch("raw"), "id", 4), VersionedTable(spark, scratch("plain"))
    batches = [batch(spark, 60, set()), batch(spark, 80, {3, 5, 70}, 2), records(spark, [("5", '{"v":1.0, "id":"5"}'), (None, "{}")]),
               records(spark, []), records(spark, [("new", "not json")])]
    committed = []
    for k, b in enumerate(batches):
        now = f"2024-02-0{k + 1} 00:00:00"
        committed.append(upsert_bucketed(table, b, now))
        plain.commit(upsert_changed(plain.current(), b, now))
        assert rows_of(table.current()) == rows_of(plain.current())
    # an equal value in another spelling, an empty batch: no new version
    assert committed == [True, True, False, False, True] and table.versions() == [1, 2, 3]


def test_one_sorted_file_per_bucket_and_no_exchange_over_the_table(spark, scratch):
    base = scratch("raw")
    table = BucketedTable(spark, base, "id", 4)
    upsert_bucketed(table, batch(spark, 200, set()), T[0])
    upsert_bucketed(table, batch(spark, 220, {7}), T[1])
    files = [f.rsplit("/", 1)[1] for f in spark.read.parquet(table.path(2)).inputFiles()]
    buckets = [re.search(r"_(\d{5})\.c000", f).group(1) for f in files]
    assert sorted(buckets) == ["00000", "00001", "00002", "00003"]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables of size are joined
    try:
        current, incoming = table.current(), batch(spark, 10, {1})
        for df in (changed_keys(current, incoming, "id", ["payload"]), merged(current, incoming, "id")):
            hits = leaves_under_exchange(plan_of(df), base)
            assert hits and all(not h for h in hits), plan_of(df)
        # the check sees an exchange where there is one
        plain = spark.read.parquet(table.path(2))
        assert any(leaves_under_exchange(plan_of(merged(plain, incoming, "id")), base))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_plain_and_other_buckets_are_taken_over(spark, scratch):
    base = scratch("raw")
    VersionedTable(spark, base).commit(upsert_changed(None, batch(spark, 30, set()), T[0]))
    for n, now in ((3, T[1]), (5, T[2])):
        table = BucketedTable(spark, base, "id", n)
        assert not table.in_place()
        assert upsert_bucketed(table, batch(spark, 30, {n}), now) and table.in_place()
    got = {r["id"]: str(r["extracted_at"]) for r in VersionedTable(spark, base).current().collect()}
    assert got["5"] == T[2] and got["3"] == T[2] and got["4"] == T[0] and len(got) == 30
    assert rows_of(table.current()) == rows_of(VersionedTable(spark, base).current())


def test_duplicates_and_failed_commits(spark, scratch):
    base = scratch("raw")
    table = BucketedTable(spark, base, "id", 2)
    upsert_bucketed(table, batch(spark, 10, set()), T[0])
    twice = records(spark, [("1", '{"v":8}'), ("1", '{"v":9}')])
    with pytest.raises(DuplicateKeyError):
        upsert_bucketed(table, twice, T[1])
    broken = batch(spark, 10, {2}).withColumn("payload", F.when(F.col("id") == "9", F.raise_error(F.lit("lost"))).otherwise(F.col("payload")))
    with pytest.raises(Exception, match="lost"):
        table.commit(broken.withColumn("extracted_at", F.lit(T[1]).cast("timestamp")))
    assert table.versions() == [1]
    assert upsert_bucketed(table, twice, T[1], on_duplicate="last")
    assert {r["id"]: r["payload"] for r in table.current().collect()}["1"] == '{"v":9}'


def test_vacuum_and_empty_table(spark, scratch):
    table = BucketedTable(spark, scratch("raw"), "id", 3)
    upsert_bucketed(table, records(spark, []), T[0])
    assert table.current().count() == 0
    upsert_bucketed(table, batch(spark, 5, set()), T[1])
    upsert_bucketed(table, batch(spark, 5, {1}), T[2])
    assert table.vacuum(1) == [1, 2] and table.current().count() == 5


def test_same_history_as_the_plain_step(spark, scratch):
    schema = "id string, name string, level int"
    runs = [[("a", "x", 1), ("b", "y", None), ("c", "z", 3)], [("a", "x", 1), ("b", "y", 2), ("d", None, None), (None, "n", 0)],
            [("a", "x2", 1), ("b", "y", None)], []]
    plain, bucketed = SnapshotStore(spark, scratch("plain")), BucketedSnapshotStore(spark, scratch("bucketed"), "id", 3)
    for k, run in enumerate(runs):
        source, now = spark.createDataFrame(run, schema), f"2024-03-0{k + 1} 00:00:00"
        plain.commit(*scd2_step(plain.current(), source, now), now)
        bucketed.commit(*scd2_bucketed(bucketed.current(), source, now), now)
        assert rows_of(plain.snapshot()) == rows_of(bucketed.snapshot())
    assert bucketed.snapshot().columns == ["id", "name", "level", *META]


def test_refresh_with_buckets_equals_refresh_without(spark, scratch):
    from linkmart.plans.catalog import TESTBED
    from linkmart.plans.refresh import ingest_and_snapshot
    from linkmart.sources import testbed as tb

    sf, outs = "/root/testdata/sf0.001", (scratch("plain"), scratch("buckets"))
    for b, now in ((1, tb.T1), (2, tb.T2), (2, "2024-05-01 00:00:00")):
        incoming = {"orders": tb.order_records(spark, sf, b), "customers": tb.customer_records(spark, sf, b)}
        (raw, snaps), (raw2, snaps2) = (
            ingest_and_snapshot(spark, TESTBED, incoming, out, now, buckets=n) for out, n in zip(outs, (None, 4)))
    for name in incoming:
        assert rows_of(raw[name]) == rows_of(raw2[name]) and rows_of(snaps[name]) == rows_of(snaps2[name])
    # the third run changed nothing
    assert VersionedTable(spark, f"{outs[1]}/raw/orders").versions() == [1, 2]


def test_a_batch_is_computed_once_and_stored_texts_are_not_parsed(spark, scratch):
    table = BucketedTable(spark, scratch("raw"), "id", 4)
    upsert_bucketed(table, batch(spark, 40, set()), T[0])
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        made.add(1)
        return text

    for n, (changed, commits) in enumerate([({3, 7}, True), ({3, 7}, False), (set(), True)], 1):
        incoming = batch(spark, 40, changed).withColumn("payload", counted("payload"))
        assert upsert_bucketed(table, incoming, T[1]) == commits
        assert made.value == 40 * n  # the look and the merge share what was staged
    names = {r["name"] for r in spark.sql("SHOW TABLES").selectExpr("tableName AS name").collect()}
    assert not [f for n in names if n.startswith("linkmart_") for f in spark.table(n).inputFiles() if "/staged-" in f]


def test_keys_and_spellings_in_one_batch(spark, scratch):
    table, plain = BucketedTable(spark, scratch("raw"), "id", 3), VersionedTable(spark, scratch("plain"))
    first = [("a", '{"x":1,"y":"e"}'), ("b", None), ("c", "not json"), ("d", '{"x":2}'), (None, "{}")]
    second = [("a", '{ "y":"e", "x":1e0 }'), ("b", None), ("c", "not  json"), ("d", None), ("e", None), ("f", '{"n":1.50}')]
    for rows, now in ((first, T[0]), (second, T[1]), (second, T[2])):
        upsert_bucketed(table, records(spark, rows), now)
        plain.commit(upsert_changed(plain.current(), records(spark, rows), now))
        assert rows_of(table.current()) == rows_of(plain.current())
    assert table.versions() == [1, 2]


def test_records_of_one_row_group_are_made_by_all_cores(spark):
    from linkmart.sources import testbed as tb

    for rows, key in ((tb.order_records, "o_orderkey"), (tb.customer_records, "c_custkey")):
        assert f"Exchange hashpartitioning({key}" in plan_of(rows(spark, "/root/testdata/sf0.001", 2))
