"""Batch extraction: the ledger of runs, resume, staged batches, stored quarantine."""

import datetime as dt
import json
import os

import pytest

from linkmart.plans import extract as X
from linkmart.plans.extract import RunEnd, extract, mark_applied, pending, plan_takes, stored_quarantine, stored_state

T = [dt.datetime(2024, 1, d) for d in range(1, 9)]


def _land(root, source, page, records=None, text=None, run=None):
    d = os.path.join(root, f"source={source}", *([f"run={run}"] if run else []), f"page={page}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write(text if text is not None else json.dumps({"data": records}))


def _full(n, v=None):
    return [{"id": f"{n}-{i}"} | ({"v": v} if v else {}) for i in range(50)]


def _state(spark, out):
    return {r["source_name"]: (r["status"], r["last_completed_page"], r["records_loaded"], r["error_message"])
            for r in stored_state(spark, out).collect()}


class Tables:
    """Applies handed out batches the way the raw layer does: the greatest order wins."""

    def __init__(self):
        self.rows = {}

    def apply(self, incoming):
        for source, df in incoming.items():
            for r in df.orderBy("_order").collect():
                self.rows[source, r["id"]] = r["payload"]


def _folded(root):
    """What every readable landed page gives, applied in order of run and page; a run ends at
    its first short page."""
    rows = {}
    for source in sorted(os.listdir(root)):
        runs = os.listdir(os.path.join(root, source))
        for run in sorted(runs, key=lambda r: X.run_key(r)):
            pages = sorted(os.listdir(os.path.join(root, source, run)), key=lambda p: int(p[5:]))
            for page in pages:
                with open(os.path.join(root, source, run, page, "p.json")) as f:
                    try:
                        data = json.load(f)["data"]
                    except ValueError:
                        continue
                for r in data:
                    rows[source[7:], r["id"]] = json.dumps(r, separators=(",", ":"), sort_keys=True)
                if len(data) < 50:
                    break
    return rows


def test_sources_end_on_their_own(spark, scratch):
    root, out = scratch("pages"), scratch("out")
    _land(root, "whole", 0, _full(0))
    _land(root, "whole", 1, [{"id": "last"}, "junk"])
    _land(root, "stops", 0, _full(0))
    _land(root, "stops", 1, [])
    _land(root, "stops", 2, _full(2))
    _land(root, "empty", 0, [])
    _land(root, "broken", 0, _full(0))
    _land(root, "broken", 1, text='{"data": [1')
    _land(root, "broken", 2, [{"id": "after"}])
    incoming = extract(spark, root, out, T[0], T[1])
    assert {k: v.count() for k, v in incoming.items()} == {"whole": 51, "stops": 50, "empty": 0, "broken": 50}
    assert _state(spark, out) == {
        "whole": ("completed", 1, 51, None), "stops": ("completed", 0, 50, None),
        "empty": ("completed", None, 0, None), "broken": ("failed", 0, 50, "malformed page 1"),
    }
    assert [r["reason"] for r in stored_quarantine(spark, out).collect()] == ["not_a_dict"]

    mark_applied(spark, out)
    # the page is mended: the failed source resumes, the completed ones start again
    _land(root, "broken", 1, _full(1))
    incoming = extract(spark, root, out, T[2], T[3])
    assert {k: v.count() for k, v in incoming.items() if v.count()} == {"whole": 51, "stops": 50, "broken": 51}
    assert _state(spark, out)["broken"] == ("completed", 2, 101, None)
    assert _state(spark, out)["whole"] == ("completed", 1, 51, None)
    assert stored_quarantine(spark, out).count() == 1  # the same landing again


def test_every_run_is_applied_in_the_order_of_its_number(spark, scratch):
    root, out, t = scratch("pages"), scratch("out"), Tables()
    for run, v in (("9", "old"), ("10", "new")):
        _land(root, "s", 0, _full(0, v) if run == "9" else [{"id": "0-1", "v": v}, "junk"], run=run)
    _land(root, "s", 1, [{"id": "only in 9"}], run="9")
    t.apply(extract(spark, root, out, T[0], T[1]))
    assert t.rows == {**_folded_without_junk(root)}
    assert t.rows["s", "0-1"] == '{"id":"0-1","v":"new"}' and ("s", "only in 9") in t.rows
    assert _state(spark, out) == {"s": ("completed", 0, 1, None)}
    assert [r["reason"] for r in stored_quarantine(spark, out).collect()] == ["not_a_dict"]
    mark_applied(spark, out)
    assert extract(spark, root, out, T[2], T[3]) == {}  # completed runs are not read again


def _folded_without_junk(root):
    rows = {}
    for run in ("9", "10"):
        for page in (0, 1):
            path = os.path.join(root, "source=s", f"run={run}", f"page={page}", "p.json")
            if os.path.exists(path):
                with open(path) as f:
                    rows |= {("s", r["id"]): json.dumps(r, separators=(",", ":")) for r in json.load(f)["data"] if isinstance(r, dict)}
    return rows


def test_a_failed_run_then_a_full_one(spark, scratch):
    """Run 1 failed at page 2; run 2 is a full re-extraction of 101 records, 100 changed."""
    root, out, t = scratch("pages"), scratch("out"), Tables()
    _land(root, "s", 0, _full(0), run="1")
    _land(root, "s", 1, _full(1), run="1")
    _land(root, "s", 2, text='{"data": [', run="1")
    _land(root, "s", 3, [{"id": "behind the break"}], run="1")
    t.apply(extract(spark, root, out, T[0], T[1]))
    assert len(t.rows) == 100 and _state(spark, out)["s"] == ("failed", 1, 100, "malformed page 2")
    mark_applied(spark, out)
    for page, records in enumerate([_full(0, "x"), _full(1, "x"), [{"id": "2-0"}]]):
        _land(root, "s", page, records, run="2")
    t.apply(extract(spark, root, out, T[2], T[3]))
    assert len(t.rows) == 102 and t.rows == _folded(root)
    assert _state(spark, out)["s"] == ("completed", 2, 101, None)
    assert [r["reason"] for r in stored_quarantine(spark, out).collect()] == ["malformed_page"]


def test_a_run_that_resumes_another(spark, scratch):
    """Run 1 fails at page 1, run 2 lands only the pages from there on, both before extract."""
    root, out, t = scratch("pages"), scratch("out"), Tables()
    _land(root, "s", 0, _full(0), run="1")
    _land(root, "s", 1, text="", run="1")
    _land(root, "s", 1, _full(1), run="2")
    _land(root, "s", 2, [{"id": "end"}], run="2")
    t.apply(extract(spark, root, out, T[0], T[1]))
    # the latest run waits for its page 0
    assert len(t.rows) == 50 and _state(spark, out)["s"] == ("in_progress", None, 0, None)
    mark_applied(spark, out)
    _land(root, "s", 0, [{"id": "0-0", "v": "later"}], run="3")
    t.apply(extract(spark, root, out, T[2], T[3]))
    assert t.rows == _folded(root) and len(t.rows) == 101


def test_pages_that_land_later(spark, scratch):
    root, out, t = scratch("pages"), scratch("out"), Tables()
    _land(root, "s", 0, _full(0), run="7")
    _land(root, "s", 2, [{"id": "end"}], run="7")
    t.apply(extract(spark, root, out, T[0], T[1]))
    mark_applied(spark, out)
    assert _state(spark, out)["s"] == ("in_progress", 0, 50, None)
    _land(root, "s", 1, _full(1), run="7")
    t.apply(extract(spark, root, out, T[2], T[3]))
    assert t.rows == _folded(root) and _state(spark, out)["s"] == ("completed", 2, 101, None)


@pytest.mark.parametrize("marked", [True, False])
def test_a_run_that_lands_after_a_later_one_gives_way(spark, scratch, marked):
    root, out, t = scratch("pages"), scratch("out"), Tables()
    _land(root, "s", 0, [{"id": "a", "v": 10}, {"id": "b"}], run="10")
    first = extract(spark, root, out, T[0], T[1])
    if marked:
        t.apply(first)
        mark_applied(spark, out)
    _land(root, "s", 0, [{"id": "a", "v": 9}, {"id": "c", "v": 9}], run="9")
    t.apply(extract(spark, root, out, T[2], T[3]))
    assert t.rows == _folded(root) and t.rows["s", "a"] == '{"id":"a","v":10}' and ("s", "c") in t.rows
    assert _state(spark, out)["s"] == ("completed", 0, 2, None)  # the state is run 10's


def test_a_crash_between_any_two_steps_loses_nothing(spark, scratch, monkeypatch):
    root = scratch("pages")
    for run in ("1", "2"):
        _land(root, "s", 0, _full(0, run), run=run)
        _land(root, "s", 1, [{"id": "end", "v": run}], run=run)
    real, crash_at = X.VersionedTable.commit, None

    def commit(self, df, *args):
        nonlocal crash_at
        crash_at -= 1
        if crash_at < 0:
            raise RuntimeError("crash")
        return real(self, df, *args)

    monkeypatch.setattr(X.VersionedTable, "commit", commit)
    for steps in range(4):  # before the begin mark, the takes, the ledger; none
        out, t, crash_at = scratch("out"), Tables(), steps
        if steps < 3:
            with pytest.raises(RuntimeError):
                extract(spark, root, out, T[0], T[1])
        crash_at = 99
        extract(spark, root, out, T[2], T[3])  # its caller is lost before it applies anything
        t.apply(extract(spark, root, out, T[4], T[5]))
        assert t.rows == _folded(root), steps
        assert _state(spark, out)["s"] == ("completed", 1, 51, None)
        mark_applied(spark, out)
        assert pending(spark, out) == {}


def test_a_failed_refresh_is_handed_its_batch_again(spark, scratch, monkeypatch):
    from linkmart.plans import refresh as R
    from linkmart.plans.catalog import WAREHOUSE

    root, out = scratch("pages"), scratch("out")
    _land(root, "games", 0, [{"id": "g", "name": "G"}], run="1")
    with monkeypatch.context() as m:
        m.setattr(R, "build_models", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            R.extract_and_refresh(spark, WAREHOUSE, root, out, T[0], T[1])
    assert _state(spark, out)["games"][0] == "completed"
    written = R.extract_and_refresh(spark, WAREHOUSE, root, out, T[2], T[3])
    assert [r["game_id"] for r in written["dim_game" if "dim_game" in written else "dim_games"].collect()] == ["g"]
    assert pending(spark, out) == {}


def test_the_first_failure_ends_the_extraction(spark, scratch):
    root, out = scratch("pages"), scratch("out")
    _land(root, "a", 0, [{"id": "1"}], run="1")
    _land(root, "b", 0, text="{", run="1")
    _land(root, "c", 0, [{"id": "3"}], run="1")
    got = extract(spark, root, out, T[0], T[1], source_order=["a", "b", "c"])
    assert sorted(got) == ["a", "b"] and _state(spark, out) == {
        "a": ("completed", 0, 1, None), "b": ("failed", None, 0, "malformed page 0")}
    _land(root, "b", 0, [{"id": "2"}], run="1")
    mark_applied(spark, out)
    got = extract(spark, root, out, T[2], T[3], source_order=["a", "b", "c"])
    assert {s: df.count() for s, df in got.items()} == {"b": 1, "c": 1}


def test_take_plan():
    ends = [RunEnd("s", "10", 0, short=3, gap=4, last=3), RunEnd("s", "9", 2, bad=4, gap=8, short=7, last=7)]
    takes = plan_takes(ends, {})
    assert [(t.run, t.first, t.last, t.status, t.next_page, t.closed) for t in takes] == [
        ("9", 2, 7, "failed", 8, True), ("10", 0, 3, "completed", 4, False)]
    # full pages to the last: without a run folder that is all, a run with one waits for its end
    assert [(t.status, t.last, t.next_page) for t in plan_takes([RunEnd("s", "", 0, gap=3, last=2)], {})] == [("completed", 2, 3)]
    assert [(t.status, t.last, t.next_page) for t in plan_takes([RunEnd("s", "1", 0, gap=3, last=2)], {})] == [("in_progress", 2, 3)]
    assert plan_takes([RunEnd("s", "", 0, gap=1, last=2)], {})[0].status == "in_progress"
    (t,) = plan_takes([RunEnd("s", "9", 0, gap=0)], {"s": X.run_key("10")})
    assert (t.first, t.last, t.late, t.status) == (0, -1, True, "failed")
