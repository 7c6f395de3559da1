import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from billsift.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", app="billsift-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
