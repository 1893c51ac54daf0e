import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="quire-tests")
    # tests own their shared folder (a cluster names one in spark.checkpoint.dir)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quire-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def workdir():
    return tempfile.mkdtemp(prefix="quire-test-")
