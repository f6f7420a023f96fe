import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from polyvox.session import get_session
    ckpt = tempfile.mkdtemp(prefix="polyvox-test-ckpt-")
    s = get_session("local[4]", app="polyvox-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
