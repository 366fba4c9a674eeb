from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nestdoc.session import get_spark  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="nestdoc-wh-")
    s = get_spark(
        app="nestdoc-tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="nestdoc-test-")
