"""Landed pages are read complete, or reported malformed."""

import json
import os

from pyspark.sql import functions as F

from linkmart.operators.records import label_records
from linkmart.sources import testbed as tb
from linkmart.sources.pages import (
    explode_records, ingest_pages, landed_runs, malformed_pages, missing_pages, read_pages, read_pages_stream, run_key,
    run_order,
)


def _land(root, source, page, text):
    d = os.path.join(root, f"source={source}", f"page={page}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write(text)


def test_layouts_and_envelopes(spark, scratch):
    root = scratch("pages")
    recs = [{"id": "1", "v": "a"}, {"id": "2"}]
    _land(root, "007", 0, json.dumps({"data": recs}, indent=2))
    _land(root, "007", 1, "")
    _land(root, "007", 2, json.dumps({"data": {"id": "1"}}))
    _land(root, "007", 3, json.dumps(recs))
    _land(root, "007", 4, '{"data": [{"id": "3", "a": 1, "a": 2}, {"id": "4"}]}')
    _land(root, "007", 5, json.dumps({"data": None}))
    _land(root, "007", 6, json.dumps({"other": 1}))
    _land(root, "007", 7, '{"data": [{"id": "9"}, {"id"')
    pages = read_pages(spark, root)
    # a file of no bytes is not read: its page is missing
    assert sorted(tuple(r) for r in pages.select("source", "page").collect()) == [("007", i) for i in (0, 2, 3, 4, 5, 6, 7)]
    assert [tuple(r) for r in missing_pages(pages).collect()] == [("007", "", 1)]
    bad = sorted(r["page"] for r in malformed_pages(pages).collect())
    assert bad == [2, 3, 7]
    rows = {(r["page"], r["pos"]): (r["id"], r["reason"]) for r in label_records(explode_records(pages)).collect()}
    assert rows == {(0, 0): ("1", None), (0, 1): ("2", None), (4, 0): (None, "unparseable_json"), (4, 1): ("4", None)}


def test_batch_quarantine_keeps_every_landing(spark, scratch):
    one, two = scratch("a"), scratch("b")
    for root in (one, two):
        _land(root, "s", 0, json.dumps({"data": ["junk", {"id": "1"}]}))
    ids = []
    for root in (one, two):
        incoming, bad = ingest_pages(read_pages(spark, root), "2024-01-01")
        assert set(incoming) == {"s"}
        ids += [r["raw_id"] for r in bad.collect()]
    assert len(set(ids)) == 2


def test_filters_on_places_prune_the_files(spark, scratch):
    root = scratch("pages")
    for run in ("9", "10", "2024-01-01T00:00"):
        for page in range(2):
            d = os.path.join(root, "source=s", f"run={run.replace(':', '%3A')}", f"page={page}")
            os.makedirs(d)
            with open(os.path.join(d, "p.json"), "w") as f:
                f.write('{"data": [{"id": "1"}]}')
    _land(root, "007", 0, '{"data": [{"id": "2"}]}')
    pages = read_pages(spark, root)
    got = sorted(tuple(r) for r in pages.select("source", "run", "page").collect())
    assert got == sorted([("007", "", 0), *(("s", r, p) for r in ("9", "10", "2024-01-01T00:00") for p in (0, 1))])
    some = pages.where((F.col("source") == "s") & (F.col("run") == "9") & (F.col("page") == 1))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and some.count() == 1
    assert [x[:2] for x in landed_runs(spark, root)] == [("007", ""), ("s", "10"), ("s", "2024-01-01T00:00"), ("s", "9")]
    assert read_pages(spark, root, [x for x in landed_runs(spark, root) if x[1] == "10"]).count() == 2
    assert read_pages(spark, scratch("none")).count() == 0


def test_runs_are_ordered_with_digits_as_numbers(spark):
    runs = ["10", "9", "r2-1", "r10", "2024-01-02", "2024-01-10", "a", "", "09"]
    rows = spark.createDataFrame([(r,) for r in runs], "run string").select("run", run_order(F.col("run")).alias("k")).collect()
    assert {r["run"]: r["k"] for r in rows} == {r: run_key(r) for r in runs}
    assert sorted(["10", "9", "2024-01-10", "2024-01-02"], key=run_key) == ["9", "10", "2024-01-02", "2024-01-10"]


def test_landed_pages_are_packed_and_read_as_single_ones(spark, scratch):
    # 600 pages of one run: a folder and a file each before, now a file for 256 of them
    rows = [("s", "1", p, 0, '{"id": "%d",\n\t"name": "ä %s"}' % (p, "x" * 100)) for p in range(600)]
    frame = spark.createDataFrame(rows, "source string, run string, page int, pos int, json string")
    path = scratch("packed")
    cut = F.when(F.col("page") == 5, F.lit('{"data":[')).otherwise(F.col("_b"))
    tb.land_pages(frame, path, run="run", body=cut)
    tb.land_pages(frame.where("page = 7"), path, run="run", mode="append")  # page 7 is landed again
    os.makedirs(f"{path}/source=s/run=1/page=600")
    with open(f"{path}/source=s/run=1/page=600/p.json", "w") as f:
        f.write('{"data": []}')
    files = [f for _, _, names in os.walk(path) for f in names if not f.startswith((".", "_"))]
    assert len(files) <= 6
    pages = read_pages(spark, path)
    assert [r[0] for r in pages.select("page").orderBy("page").collect()] == sorted([*range(601), 7])
    assert pages.select("file").distinct().count() == 602  # the place of each landing
    assert [(r["run"], r["page"]) for r in malformed_pages(pages).collect()] == [("1", 5)]
    ids = [r["id"] for r in label_records(explode_records(pages)).where("reason IS NULL").collect()]
    assert sorted(ids) == sorted([*(str(p) for p in range(600) if p != 5), "7"])
    seen = []
    q = read_pages_stream(spark, path, 256).writeStream.foreachBatch(
        lambda batch, _: seen.extend(tuple(r) for r in batch.select("source", "run", "page", "file").collect())) \
        .option("checkpointLocation", scratch("cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(seen) == sorted(tuple(r) for r in pages.select("source", "run", "page", "file").collect())
