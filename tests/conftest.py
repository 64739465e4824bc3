import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = os.environ.get("REVIEWLENS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from reviewlens.session import get_session
    return get_session(master="local[4]", shuffle_partitions=8)


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="reviewlens-test-")
