import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from listinglake.session import build_session
    scratch = tempfile.mkdtemp(prefix="listinglake-tests-")
    s = build_session("local[4]", shuffle_partitions=4, app_name="listinglake-tests",
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                              "spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="listinglake-t-")
