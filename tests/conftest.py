import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from moodlake.session import get_session
    s = get_session("local[*]", app="moodlake-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="moodlake-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
