import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from spacetime.session import build_session, checkpoint_dir

    s = build_session("local[*]", app="spacetime-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh scratch folder per test (pytest gives each test its own)."""
    return str(tmp_path)
