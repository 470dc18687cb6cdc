import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from clockwright.session import local_session  # noqa: E402

# a zone with daylight saving: results must not depend on it
ZONE = os.environ.get("TEST_ZONE", "America/New_York")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, zone=ZONE, memory="4g", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
