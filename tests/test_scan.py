"""Two-level scans: neighbours over block borders, replays with a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from linkmart.operators.scan import BLOCK, blocked, neighbour
from linkmart.operators.snapshots import scd2_replay
from linkmart.operators.upsert import upsert_replay, upsert_sequence

T0 = dt.datetime(2024, 1, 1)


def _rows(n=3000):
    """A third of the rows belong to one key, some to a NULL key, the rest to small ones."""
    rnd = random.Random(9)
    keys = ["hot"] * (n // 3) + [None] * (n // 20) + [f"k{rnd.randrange(n // 6)}" for _ in range(n - n // 3 - n // 20)]
    seen, out = {}, []
    for k in keys:
        seen[k] = seen.get(k, 0) + 1
        out.append((k, seen[k], rnd.choice("aab")))
    rnd.shuffle(out)
    return out


@pytest.fixture(autouse=True)
def many_blocks(spark):
    """Small parts are not joined, as large ones would not be."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_neighbours_equal_a_plain_scan(spark):
    rows = _rows()
    df = blocked(spark.createDataFrame(rows, "k string, o long, v string").repartition(6), "k", "o")
    both = neighbour(neighbour(df, "k", "o", ["v"], "p"), "k", "o", ["o", "v"], "n", step=1)
    by_key = {}
    for k, o, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        by_key.setdefault(k, []).append((o, v))
    want = set()
    for k, seq in by_key.items():
        for i, (o, v) in enumerate(seq):
            want.add((k, o, v, seq[i - 1][1] if i else None, seq[i + 1] if i + 1 < len(seq) else None))
    got = [(r["k"], r["o"], r["v"], r["p"] and r["p"]["v"], r["n"] and tuple(r["n"])) for r in both.collect()]
    assert len(got) == len(rows) and set(got) == want
    # the hot key is in several blocks, and no block has much more than its share of rows
    sizes = {r[BLOCK]: r["count"] for r in df.groupBy(BLOCK).count().collect()}
    assert df.where("k = 'hot'").select(BLOCK).distinct().count() > 1
    assert max(sizes.values()) < len(rows) / 3


def test_replays_of_a_hot_key(spark):
    rows = [r for r in _rows(1500) if r[0] is not None]
    changes = spark.createDataFrame([(k, T0 + dt.timedelta(days=o), v) for k, o, v in rows], "k string, day timestamp, v string")
    versions, final = [], {}
    by_key = {}
    for k, o, v in sorted(rows):
        by_key.setdefault(k, []).append((T0 + dt.timedelta(days=o), v))
    for k, seq in by_key.items():
        kept = [(d, v) for i, (d, v) in enumerate(seq) if i == 0 or seq[i - 1][1] != v]
        versions += [(k, v, d, kept[i + 1][0] if i + 1 < len(kept) else None) for i, (d, v) in enumerate(kept)]
        final[k] = kept[-1]
    got = scd2_replay(changes, "k", "day", ["v"]).select("k", "v", "valid_from", "valid_to").collect()
    assert sorted(map(tuple, got), key=str) == sorted(versions, key=str)
    raw = upsert_replay(changes, "k", "day", payload="v").collect()
    assert {r["k"]: (r["extracted_at"], r["v"]) for r in raw} == final


def test_a_sequence_goes_on_from_the_current_order(spark):
    """Applying pages in two parts, the second with an old page in it, equals one sequence
    without that page."""
    rnd = random.Random(4)
    recs = [(f"k{rnd.randrange(40)}" if rnd.random() < .6 else "hot", rnd.choice("ab"), page, pos, T0 + dt.timedelta(days=page))
            for page in range(30) for pos in range(20)]
    schema = "id string, payload string, page int, pos int, now timestamp"
    empty = spark.createDataFrame([], "id string, payload string, extracted_at timestamp")

    def apply(current, records):
        return upsert_sequence(current, spark.createDataFrame(records, schema), ["page", "pos"], "now")

    whole = apply(empty, recs)
    part = apply(empty, [r for r in recs if r[2] < 20])
    late = [(k, "stale", 3, 50 + i, T0) for i, k in enumerate(sorted({r[0] for r in recs if 3 < r[2] < 20}))]
    again = apply(part, [r for r in recs if r[2] >= 20] + late)
    assert sorted(map(str, again.collect())) == sorted(map(str, whole.collect()))
    assert again.where(F.col("payload") == "stale").count() == 0
