import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from holdwise.session import local_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="holdwise-tests")
    shared_dir(s)
    yield s
    s.stop()
