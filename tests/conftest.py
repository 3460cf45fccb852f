import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import build_session
    ckpt = tempfile.mkdtemp(prefix="ledgerlens-test-ckpt-")
    s = build_session("local[4]", app_name="ledgerlens-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test data not present")
    return SF_SMALL


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="ledgerlens-test-")
