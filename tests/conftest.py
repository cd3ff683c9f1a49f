import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chartwise.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="chartwise-test-ckpt-")  # tests set their own shared folder
    s = build_session("local[*]", "chartwise-tests", shuffle_partitions=8, small_input=True,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="chartwise-test-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="chartwise-case-")
