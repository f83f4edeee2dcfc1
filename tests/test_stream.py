import json
import os

from pyspark.sql import functions as F

from linkmart.streaming.ingest import ingest_stream, raw_table, stream_state


def _land(root, page, records, mtime_ms=None):
    """Land one page; ``mtime_ms`` pins the file time (a sequential pager lands pages
    at increasing times; the file stream reads in file-time order)."""
    d = os.path.join(root, "source=things", f"page={page}")
    os.makedirs(d, exist_ok=True)
    path = os.path.join(d, "p.json")
    with open(path, "w") as f:
        f.write(json.dumps({"data": records}) + "\n")
    t = (mtime_ms if mtime_ms is not None else 1_700_000_000_000 + 1000 * page) / 1000
    os.utime(path, (t, t))


PAGES = [
    [{"id": "1", "v": "a"}, {"id": "2", "v": "a"}, "junk"],
    [{"id": "1", "v": "b"}, {"name": "no id"}],
    [{"id": "1", "v": "a"}, {"id": "3", "v": "c"}],
]


def _now():
    return F.timestamp_seconds(F.col("page").cast("long") * 86400)


def _final(spark, out):
    raw = raw_table(spark, out, "things")
    return sorted((r["id"], r["payload"], str(r["extracted_at"])) for r in raw.collect())


def test_stream_resume_equals_uninterrupted(spark, scratch):
    # uninterrupted run over all pages
    full_in, full_out = scratch("in"), scratch("out")
    for i, p in enumerate(PAGES):
        _land(full_in, i, p)
    ingest_stream(spark, full_in, full_out, f"{full_out}/_ck", now=_now())
    # interrupted: first page only, then the rest with the same checkpoint
    part_in, part_out = scratch("in"), scratch("out")
    _land(part_in, 0, PAGES[0])
    ingest_stream(spark, part_in, part_out, f"{part_out}/_ck", now=_now())
    for i, p in enumerate(PAGES[1:], 1):
        _land(part_in, i, p)
    ingest_stream(spark, part_in, part_out, f"{part_out}/_ck", now=_now())
    assert _final(spark, full_out) == _final(spark, part_out)
    got = {r[0]: r[1] for r in _final(spark, full_out)}
    assert got == {"1": '{"id":"1","v":"a"}', "2": '{"id":"2","v":"a"}', "3": '{"id":"3","v":"c"}'}
    q = spark.read.parquet(f"{part_out}/quarantine")
    assert sorted(r["reason"] for r in q.collect()) == ["missing_id", "not_a_dict"]
    st = stream_state(spark, part_out).first()
    assert st["last_completed_page"] == 2 and st["records_loaded"] == 5
    assert st["status"] == "completed" and st["error_message"] is None


def test_stream_failure_marks_run_failed_and_resumes(spark, scratch):
    import pytest

    src, out = scratch("in"), scratch("out")
    _land(src, 0, PAGES[0])
    bad = os.path.join(src, "source=things", "page=1")
    os.makedirs(bad, exist_ok=True)
    with open(os.path.join(bad, "p.json"), "w") as f:
        f.write('{"data": [1, 2')
    with pytest.raises(Exception):
        ingest_stream(spark, src, out, f"{out}/_ck", now=_now())
    st = stream_state(spark, out).first()
    assert st["status"] == "failed" and "malformed page 1" in st["error_message"]
    assert st["last_completed_page"] == 0 and st["records_loaded"] == 2


def test_stream_out_of_order_pages_same_result(spark, scratch):
    """Pages arriving in reverse file-time order give the same table as in order."""
    src, out = scratch("in"), scratch("out")
    for i, p in enumerate(PAGES):
        _land(src, i, p, mtime_ms=1_700_000_000_000 - 1000 * i)
    ingest_stream(spark, src, out, f"{out}/_ck", now=_now())
    ref_src, ref_out = scratch("in"), scratch("out")
    for i, p in enumerate(PAGES):
        _land(ref_src, i, p)
    ingest_stream(spark, ref_src, ref_out, f"{ref_out}/_ck", now=_now())
    assert _final(spark, out) == _final(spark, ref_out)


def test_replayed_batch_changes_nothing(spark, scratch):
    """At-least-once: a batch processed twice (same epoch) leaves the same tables."""
    from linkmart.streaming.ingest import _process
    from linkmart.sources.pages import read_pages

    src, out = scratch("in"), scratch("out")
    for i, p in enumerate(PAGES):
        _land(src, i, p)
    batch = read_pages(spark, src)
    _process(spark, batch, 0, out, _now(), "fail")
    once = (_final(spark, out), spark.read.parquet(f"{out}/quarantine").count())
    _process(spark, batch, 0, out, _now(), "fail")
    twice = (_final(spark, out), spark.read.parquet(f"{out}/quarantine").count())
    assert once == twice and once[1] == 2


def test_stream_result_equals_batch_result(spark, scratch):
    """The stream's raw table equals applying the same pages in one batch (page order)."""
    from linkmart.operators.upsert import upsert_sequence
    from linkmart.sources.pages import ingest_pages, read_pages

    src, out = scratch("in"), scratch("out")
    for i, p in enumerate(PAGES):
        _land(src, i, p)
    ingest_stream(spark, src, out, f"{out}/_ck", now=_now(), files_per_trigger=2)
    incoming, quarantined = ingest_pages(read_pages(spark, src), "2024-01-01")
    inc = incoming["things"].select("id", "payload", "_order.page", "_order.pos").withColumn(
        "now", _now())
    empty = spark.createDataFrame([], "id string, payload string, extracted_at timestamp")
    batch = upsert_sequence(empty, inc, ["page", "pos"], "now").drop("_ord")
    got = sorted((r["id"], r["payload"], str(r["extracted_at"])) for r in batch.collect())
    assert got == _final(spark, out)
    assert quarantined.count() == spark.read.parquet(f"{out}/quarantine").count()


def test_stream_quarantines_malformed_pages(spark, scratch):
    src, out = scratch("in"), scratch("out")
    _land(src, 0, PAGES[0])
    bad = os.path.join(src, "source=things", "page=1")
    os.makedirs(bad, exist_ok=True)
    with open(os.path.join(bad, "p.json"), "w") as f:
        f.write('{"data": [1, 2')
    _land(src, 2, PAGES[2])
    ingest_stream(spark, src, out, f"{out}/_ck", now=_now(), on_malformed="quarantine")
    reasons = sorted(r["reason"] for r in spark.read.parquet(f"{out}/quarantine").collect())
    assert reasons == ["malformed_page", "not_a_dict"]
    assert stream_state(spark, out).first()["status"] == "completed"


def test_reextraction_applies_every_load(spark, scratch):
    """The same pages landed day after day, without and with a run folder: every load
    counts, in its order, and each bad record is kept per load."""
    for with_run in (False, True):
        src, out = scratch("in"), scratch("out")
        for day, v in enumerate("abca"):
            folder = os.path.join(src, "source=things", *([f"run=2024-01-0{day + 1}"] if with_run else []), "page=0")
            os.makedirs(folder, exist_ok=True)
            path = os.path.join(folder, f"p{day}.json")
            with open(path, "w") as f:
                f.write(json.dumps({"data": [{"id": "1", "v": v}, {"id": "2", "v": "same"}, "junk"]}))
            t = 1_700_000_000 + 86400 * day
            os.utime(path, (t, t))
            ingest_stream(spark, src, out, f"{out}/_ck",
                          now=F.date_trunc("day", F.col("modified")).cast("timestamp"))
        raw = {r["id"]: r for r in raw_table(spark, out, "things").collect()}
        assert raw["1"]["payload"] == '{"id":"1","v":"a"}' and str(raw["1"]["extracted_at"])[:10] == "2023-11-17"
        assert str(raw["2"]["extracted_at"])[:10] == "2023-11-14"
        assert spark.read.parquet(f"{out}/quarantine").count() == 4
        st = stream_state(spark, out).first()
        assert st["records_loaded"] == (2 if with_run else 8) and st["status"] == "completed"


def test_a_malformed_page_fails_its_own_source(spark, scratch):
    import pytest

    src, out = scratch("in"), scratch("out")
    _land(src, 0, PAGES[0])
    ingest_stream(spark, src, out, f"{out}/_ck", now=_now())
    bad = os.path.join(src, "source=other", "page=3")
    os.makedirs(bad, exist_ok=True)
    with open(os.path.join(bad, "p.json"), "w") as f:
        f.write('{"data": [1')
    with pytest.raises(Exception):
        ingest_stream(spark, src, out, f"{out}/_ck", now=_now())
    st = {r["source_name"]: r for r in stream_state(spark, out).collect()}
    assert st["other"]["status"] == "failed" and st["other"]["error_message"] == "malformed page 3 of other"
    assert st["things"]["status"] == "in_progress" and st["things"]["records_loaded"] == 2


def _reingest(spark, src, out):
    ingest_stream(spark, src, out, f"{out}/_ck", now=_now())


def test_compaction_changes_nothing(spark, scratch):
    """Ingest, compact and ingest in any mixture: the table is that of the whole log."""
    from linkmart.streaming.ingest import _unfolded, compact

    tables = []
    for compact_at in ((), (0,), (0, 1), (1,), (2,)):
        src, out = scratch("in"), scratch("out")
        for i, p in enumerate(PAGES):
            _land(src, i, p)
            _reingest(spark, src, out)
            if i in compact_at:
                compact(spark, out)
                assert _unfolded(spark, out) == []
        tables.append(_final(spark, out))
        assert stream_state(spark, out).first()["records_loaded"] == 5
    assert all(t == tables[0] for t in tables)


def test_a_replay_of_a_folded_batch_changes_nothing(spark, scratch):
    from linkmart.sources.pages import read_pages
    from linkmart.streaming.ingest import _process, compact

    src, out = scratch("in"), scratch("out")
    for i, p in enumerate(PAGES):
        _land(src, i, p)
        _process(spark, read_pages(spark, src).where(f"page = {i}"), i, out, _now(), "fail")
    before = _final(spark, out)
    compact(spark, out)
    _process(spark, read_pages(spark, src).where("page = 0"), 0, out, _now(), "fail")  # folded epoch
    assert _final(spark, out) == before
    # a stream begun anew reads the same files in other epochs
    _process(spark, read_pages(spark, src), 0, out, _now(), "fail", stream_id="other")
    assert _final(spark, out) == before
    compact(spark, out)
    assert _final(spark, out) == before


def test_a_crash_while_compacting_keeps_the_base(spark, scratch, monkeypatch):
    import pytest

    from linkmart.sources.tables import VersionedTable
    from linkmart.streaming import ingest

    src, out = scratch("in"), scratch("out")
    for i, p in enumerate(PAGES[:2]):
        _land(src, i, p)
    _reingest(spark, src, out)
    before = _final(spark, out)
    real, left = VersionedTable.commit, 0

    def commit(self, df, *args):
        nonlocal left
        left -= 1
        if left < 0:
            raise RuntimeError("crash")
        return real(self, df, *args)

    for steps in range(3):
        left = steps
        with monkeypatch.context() as m:
            m.setattr(VersionedTable, "commit", commit)
            with pytest.raises(RuntimeError):
                ingest.compact(spark, out)
        assert _final(spark, out) == before
    ingest.compact(spark, out)
    assert _final(spark, out) == before


def test_old_pages_after_compaction_and_relanded_pages(spark, scratch):
    """A page landed again without run folders is a later landing, also once the first is
    folded; a page of an earlier run that comes late never overwrites."""
    from linkmart.streaming.ingest import compact

    src, out = scratch("in"), scratch("out")
    for day, v in enumerate("ab"):
        folder = os.path.join(src, "source=things", "page=0")
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, f"p{day}.json")
        with open(path, "w") as f:
            f.write(json.dumps({"data": [{"id": "1", "v": v}]}))
        os.utime(path, (1_700_000_000 + day, 1_700_000_000 + day))
        _reingest(spark, src, out)
        compact(spark, out)
    assert [r[1] for r in _final(spark, out)] == ['{"id":"1","v":"b"}']
    src, out = scratch("in"), scratch("out")
    for run, v in (("10", "new"), ("9", "old")):
        folder = os.path.join(src, "source=things", f"run={run}", "page=0")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, "p.json"), "w") as f:
            f.write(json.dumps({"data": [{"id": "1", "v": v}, {"id": run}]}))
        _reingest(spark, src, out)
        compact(spark, out)
    assert sorted(r[:2] for r in _final(spark, out)) == [("1", '{"id":"1","v":"new"}'), ("10", '{"id":"10"}'), ("9", '{"id":"9"}')]


def test_refresh_takes_the_stream(spark, scratch):
    from linkmart.plans.catalog import WAREHOUSE
    from linkmart.plans.refresh import refresh_from_stream

    src, out, wh = scratch("in"), scratch("out"), scratch("wh")
    for day, name in enumerate(("One", "Two")):
        folder = os.path.join(src, "source=games", f"run={day + 9}", "page=0")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, "p.json"), "w") as f:
            f.write(json.dumps({"data": [{"id": "g", "name": name}, {"id": "h", "name": "Same"}, "junk"]}))
        _reingest(spark, src, out)
        w = refresh_from_stream(spark, WAREHOUSE, out, wh, f"2024-01-0{day + 1} 00:00:00")
    assert sorted((r["game_name"], r["is_current"]) for r in w["dim_games"].collect()) == [("One", False), ("Same", True), ("Two", True)]
    assert w["dead_letters"].where("error_type = 'not_a_dict'").count() == 2
