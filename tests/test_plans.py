"""Plan properties the scale design relies on (checked on the executed physical plans)."""

import os

import pytest

import __spark_entry__ as E
from linkmart.plans.testbed_queries import QUERIES

SF = os.environ.get("LINKMART_TEST_SF", "/root/testdata/sf0.001")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_python_operators(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert not [op for op in FORBIDDEN if op in plan]


@pytest.mark.parametrize("name,parses", [
    ("stage_orders", 0), ("unnest_order_customers", 0), ("fact_current", 0), ("warehouse_checks", 0),
    ("dead_letters", 2),  # of the landed pages behind its quarantine
    ("dead_letter_fields", 1), ("dead_letter_links", 2),  # over any raw table, one parse per scan
])
def test_the_raw_layer_is_not_parsed_again(spark, name, parses):
    plan = _plan(E.queries()[name](spark, SF))
    assert plan.lower().count("parsejson") == parses


def test_raw_scan_reads_only_the_parsed_fields_it_needs(spark):
    plan = _plan(E.queries()["unnest_order_customers"](spark, SF))
    assert "ReadSchema: struct<parsed:struct<text__id:string,links__customers:array<string>>>" in plan


def test_exchanges_of_a_report_do_not_grow_with_its_checks(spark):
    from linkmart.operators.checks import Check, check_report

    tables = {"a": spark.range(50).selectExpr("id", "id % 7 as b", "id % 3 as c"), "p": spark.range(5)}
    checks = [Check("a", "unique", "id"), Check("a", "relationships", "b", "p", "id")]
    more = checks + [Check("a", "unique", ("b", "c")), Check("a", "relationships", "c", "p", "id"), Check("a", "not_null", "b"),
                     Check("p", "unique", "id"), Check("a", "count", predicate="c = 1", threshold=100)]
    counts = [_plan(check_report(c, tables)).count("Exchange hashpartitioning") for c in (checks, more)]
    assert counts[0] == counts[1] <= 2
    got = {r["check_name"]: (r["failures"], r["status"]) for r in check_report(more, tables).collect()}
    assert got == {
        "unique__a__id": (0, "pass"), "relationships__a__b__p__id": (14, "fail"), "unique__a__b_c": (50, "fail"),
        "relationships__a__c__p__id": (0, "pass"), "not_null__a__b": (0, "pass"), "unique__p__id": (0, "pass"), "count__a": (0, "pass")}
