import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quernstone.session import build


@pytest.fixture(scope="session")
def spark():
    s = build(os.environ.get("TEST_CPUS", "4"), "tests", **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
