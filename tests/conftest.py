import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tabrisk.session import build_session
    s = build_session("local[*]", app="tabrisk-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="tabrisk-test-")
