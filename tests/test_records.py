import json
import os

from pyspark.sql import functions as F

from linkmart.operators.records import label_records, load_metrics, quarantine, split_records
from linkmart.sources.pages import (
    explode_records, malformed_pages, page_report, read_pages,
)


def _land(root, source, page, text):
    d = os.path.join(root, f"source={source}", f"page={page}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write(text + "\n")


def _records(spark, values):
    rows = [("s", 0, i, json.dumps(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "source_name string, page int, pos int, j string")
    return df.select("source_name", "page", "pos", F.parse_json("j").alias("value"))


def test_split_falsy_ids_and_non_objects(spark):
    values = [{"name": "x"}, {"id": None}, {"id": ""}, {"id": 0}, {"id": False}, {"id": []},
              {"id": {}}, "str", 3, None, [1], {"id": "0"}, {"id": " "}, {"id": 7, "b": 1, "a": 2}]
    good, bad = split_records(_records(spark, values))
    reasons = {r["pos"]: r["reason"] for r in bad.collect()}
    assert all(reasons[i] == "missing_id" for i in range(7))
    assert all(reasons[i] == "not_a_dict" for i in range(7, 11))
    g = {r["pos"]: (r["id"], r["payload"]) for r in good.collect()}
    assert g == {11: ("0", '{"id":"0"}'), 12: (" ", '{"id":" "}'), 13: ("7", '{"a":2,"b":1,"id":7}')}


def test_quarantine_ids_are_deterministic(spark):
    _, bad = split_records(_records(spark, ["x", {"a": 1}]))
    a = {r["raw_id"] for r in quarantine(bad, "2024-01-01").collect()}
    b = {r["raw_id"] for r in quarantine(bad, "2024-01-02").collect()}
    assert a == b and len(a) == 2


def test_pages_edge_cases(spark, scratch):
    root = scratch("pages")
    _land(root, "a", 0, json.dumps({"data": [{"id": str(i)} for i in range(50)], "meta": 1}))
    _land(root, "a", 1, json.dumps({"data": [{"id": "50"}, "bad"]}))
    _land(root, "b", 0, json.dumps({"nodata": 1}))
    _land(root, "b", 1, json.dumps({"data": []}))
    _land(root, "c", 0, '{"data": [1, 2')
    pages = read_pages(spark, root)
    recs = explode_records(pages)
    assert recs.where("source_name = 'a'").count() == 52
    assert recs.where("source_name != 'a'").count() == 0
    assert [tuple(r) for r in malformed_pages(pages).select("source_name", "page").collect()] == [("c", 0)]
    m = {(r["source_name"], r["page"]): (r["loaded"], r["quarantined"], r["loaded_total"])
         for r in load_metrics(label_records(recs)).collect()}
    assert m == {("a", 0): (50, 0, 50), ("a", 1): (1, 1, 51)}
    rep = {r["source_name"]: r for r in page_report(pages).collect()}
    assert rep["a"]["complete"] and rep["a"]["records"] == 52
    assert not rep["c"]["complete"] and rep["c"]["malformed"] == 1


def test_running_total_blocks_match_plain_window(spark):
    from pyspark.sql import Window

    from linkmart.operators.records import running_total

    rows = [("a" if i % 3 else "b", i, (i * 7) % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o int, v int")
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r["g"], r["o"]): r["t"] for r in df.select("g", "o", F.sum("v").over(w).alias("t")).collect()}
    got = {(r["g"], r["o"]): r["t"] for r in running_total(df, "g", "o", "v", "t", block=7).collect()}
    assert got == want


def test_good_plus_quarantined_equals_input(spark):
    from hypothesis import given, settings, strategies as st

    values = st.one_of(st.none(), st.booleans(), st.integers(-2, 2), st.text("ab ", max_size=2),
                       st.fixed_dictionaries({}, optional={"id": st.one_of(
                           st.none(), st.integers(0, 2), st.text("x", max_size=1)),
                           "n": st.integers(0, 1)}))

    @settings(max_examples=10, deadline=None)
    @given(st.lists(values, max_size=12))
    def check(vals):
        good, bad = split_records(_records(spark, vals))
        assert good.count() + bad.count() == len(vals)
        for r in good.collect():
            assert isinstance(vals[r["pos"]], dict) and bool(vals[r["pos"]].get("id"))

    check()


def test_ingest_pages_duplicate_policy(spark, scratch):
    import pytest

    from linkmart.operators.upsert import DuplicateKeyError
    from linkmart.sources.pages import ingest_pages

    root = scratch("dups")
    _land(root, "s", 0, json.dumps({"data": [{"id": "1", "v": 1}, {"id": "1", "v": 2}]}))
    _land(root, "s", 1, json.dumps({"data": [{"id": "1", "v": 3}]}))
    pages = read_pages(spark, root)
    with pytest.raises(DuplicateKeyError):
        ingest_pages(pages, "2024-01-01", on_duplicate="error")
    incoming, _ = ingest_pages(pages, "2024-01-01")
    from linkmart.operators.upsert import latest_per_key

    last = latest_per_key(incoming["s"], "id", ["_order"], "last").first()
    assert last["payload"] == '{"id":"1","v":3}'
