import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vaultline.session import local_test_session

    s = local_test_session(8)
    yield s
    s.stop()
