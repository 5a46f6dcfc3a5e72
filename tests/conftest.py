import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from tierline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="tierline-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    """A fresh local folder per test (tests only; jobs use the shared scratch root)."""
    return tempfile.mkdtemp(prefix="tierline-test-")
