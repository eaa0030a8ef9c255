import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ringcast.session import build_session

    session = build_session("local[4]", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def tmp_out():
    """A fresh local folder for one test's output (tests only)."""
    return tempfile.mkdtemp(prefix="ringcast-test-")
