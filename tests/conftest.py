import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from linkmart.session import get_session

    ckpt = tempfile.mkdtemp(prefix="linkmart-test-ckpt-")
    s = get_session("local[4]", app="linkmart-tests", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": ckpt,
        "spark.driver.memory": "4g",
    })
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from linkmart.session import scratch_dir

    return lambda name="t": scratch_dir(spark, name)
