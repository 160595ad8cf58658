import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vehiscope.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vs-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="vs-test-out-")
