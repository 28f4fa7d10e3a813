import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from cohortkit.session import local_session
    s = local_session(4, shuffle_partitions=8, driver_memory="4g", app="cohortkit-tests")
    yield s
    s.stop()
