"""A refresh leaves its tables on disk, not what its steps shuffled."""

import time
from pathlib import Path

import pytest

from linkmart.plans.catalog import TESTBED
from linkmart.plans.refresh import refresh
from linkmart.session import CODEC, DROP_SHUFFLES, spare_disk


def _shuffled(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def _batch(spark, star=""):
    orders = [(str(k), f'{{"customers":["u/c/{k % 7}"],"id":"{k}","name":"Order {k}{star if k % 3 == 0 else ""}","status":"O"}}') for k in range(60)]
    customers = [(str(k), f'{{"id":"{k}","name":"Customer {k}","segment":"S"}}') for k in range(5)]
    make = lambda rows: spark.createDataFrame(rows, "id string, payload string").repartition(2)
    return {"orders": make(orders), "customers": make(customers)}


def test_a_refresh_leaves_no_shuffles(spark, scratch):
    # before: the shuffles of every step stayed until the driver collected its garbage
    own, out = spark.newSession(), scratch("disk")
    own.conf.set("spark.sql.shuffle.partitions", "4")
    before = _shuffled(spark)
    for star, now in (("", "2024-01-01 00:00:00"), ("*", "2024-01-02 00:00:00")):
        written = refresh(own, TESTBED, _batch(own, star), out, now)
    end = time.time() + 30  # Spark deletes them beside the job
    while (left := _shuffled(spark) - before) and time.time() < end:
        time.sleep(0.5)
    assert left == set()
    counts = {name: df.count() for name, df in written.items()}
    assert counts["dim_orders"] == 80 and counts["dim_customers"] == 5 and counts["fct_order_customers"] == 60
    assert counts["dead_letters"] == sum(k % 7 > 4 for k in range(60))
    files = [p.name for p in Path(out.removeprefix("file:")).rglob("part-*.parquet")]
    assert files and all(n.endswith(".zstd.parquet") for n in files)


@pytest.mark.parametrize("asked", [None, "gzip"])
def test_the_settings_are_as_they_were(spark, asked):
    own = spark.newSession()
    if asked:
        own.conf.set(CODEC, asked)
    before = own.conf.getAll
    with pytest.raises(KeyError), spare_disk(own):
        assert own.conf.get(DROP_SHUFFLES) == "true"
        assert own.conf.get(CODEC) == (asked or "zstd")
        raise KeyError
    assert own.conf.getAll == before
