import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from flowscore.session import get_session
    ckpt = tempfile.mkdtemp(prefix="flowscore-test-", dir="/tmp")
    s = get_session("local[4]", app_name="flowscore-tests", shuffle_partitions=8,
                    spark__checkpoint__dir=ckpt)
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="flowscore-t-", dir="/tmp")
