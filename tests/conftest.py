import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
