import datetime as dt

from pyspark.sql import functions as F

from linkmart.operators.checks import check_relationships, check_unique
from linkmart.operators.deadletters import dead_letter_fields, dead_letter_links
from linkmart.operators.state import STATE_SCHEMA, merge_state, resume_point

T = dt.datetime(2024, 1, 1)


def _raw(spark, rows):
    return spark.createDataFrame([(i, p, T) for i, p in rows],
                                 "id string, payload string, extracted_at timestamp")


def test_dead_letter_fields_first_rule_wins(spark):
    raw = _raw(spark, [("a", '{"id":" "}'), ("b", '{"id":"b","name":"  "}'),
                       ("c", '{"id":"c","name":null}'), ("d", '{"id":"d","name":"ok"}')])
    got = {r["natural_key"]: r["error_type"] for r in dead_letter_fields(raw, "s").collect()}
    assert got == {" ": "empty_id", "b": "empty_name", "c": "missing_name"}


def test_dead_letter_links(spark):
    raw = _raw(spark, [
        ("1", '{"id":"1","g":["https://h/g/x1","https://h/g/x2"]}'),   # two broken: one row
        ("2", '{"id":"2","g":["https://h/g/ok"]}'),
        ("3", '{"id":"3","g":["https://h/g/ok/"]}'),                   # trailing slash: broken
        ("4", '{"id":"4","g":null}'),                                  # JSON null: type
        ("5", '{"id":"5"}'),                                           # missing: nothing
        ("6", '{"id":"6","g":[null]}'),                                # null element: broken
        ("7", '{"id":"7","g":"x"}'),                                   # not an array: type
    ])
    targets = spark.createDataFrame([("ok",)], "id string")
    got = sorted((r["natural_key"], r["error_type"])
                 for r in dead_letter_links(raw, "s", "g", targets).collect())
    assert got == [("1", "invalid_g_link"), ("3", "invalid_g_link"), ("4", "invalid_g_type"),
                   ("6", "invalid_g_link"), ("7", "invalid_g_type")]


def test_checks_ignore_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("a",), ("b",)], "k string")
    assert [tuple(r) for r in check_unique(df, "k").collect()] == [("a", 2)]
    parent = spark.createDataFrame([("a",)], "k string")
    assert [r["k"] for r in check_relationships(df, "k", parent, "k").collect()] == ["b"]


def _state(spark, rows):
    return spark.createDataFrame(rows, STATE_SCHEMA)


def test_resume_rule(spark):
    st = _state(spark, [("a", "failed", None, T, T, "e", 0), ("b", "failed", 0, T, T, "e", 50),
                        ("c", "in_progress", 3, T, None, None, 200),
                        ("d", "completed", 9, T, T, None, 500)])
    got = {r["source_name"]: (r["start_page"], r["records_loaded"])
           for r in resume_point(st).collect()}
    assert got == {"a": (0, 0), "b": (1, 50), "c": (4, 200), "d": (0, 0)}


def test_merge_state_explicit_null_overwrites(spark):
    st = _state(spark, [("a", "failed", 3, T, T, "boom", 200)])
    upd = spark.createDataFrame([("a", "in_progress", None), ("z", "in_progress", None)],
                                "source_name string, status string, error_message string")
    got = {r["source_name"]: r for r in merge_state(st, upd).collect()}
    assert got["a"]["error_message"] is None and got["a"]["last_completed_page"] == 3
    assert got["a"]["records_loaded"] == 200 and got["z"]["records_loaded"] == 0


def test_read_state(spark):
    from linkmart.operators.state import read_state

    st = _state(spark, [("a", "failed", 3, T, T, "e", 200), ("b", "completed", 1, T, T, None, 9)])
    assert [tuple(r) for r in read_state(st, "a").collect()] == [("failed", 3, 200)]
    assert read_state(st, "zz").count() == 0


def test_register_views(spark):
    from linkmart.plans.catalog import TESTBED
    from linkmart.plans.models import build_models, register_views

    raw = {"orders": _raw(spark, [("1", '{"id":"1","name":"n","customers":["https://h/c/9"]}')])}
    names = register_views(build_models(TESTBED, raw, {}), prefix="t_")
    assert sorted(names) == ["t_int_orders__customers", "t_stg_orders"]
    assert spark.sql("select customer_id from t_int_orders__customers").first()[0] == "9"
