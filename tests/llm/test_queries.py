"""The registered queries: oracles, contracts and plans over the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "scripts"))

from check_oracle import duck, frame_digest  # noqa: E402

from linkmart.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    got = frame_digest(QUERIES[name](spark, SF).toPandas())
    want = frame_digest(duck(SF).execute(ORACLE_SQL[name]).df())
    assert got[:3] == want[:3]


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_native_pseudonyms_run_no_python(spark):
    plan = QUERIES["op1_pii"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
