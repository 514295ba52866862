import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caseloom.session import clear_scratch, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    yield session
    clear_scratch(session)


@pytest.fixture(scope="session")
def small():
    return SMALL
