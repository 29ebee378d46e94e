import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    from crease.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app="crease-tests")
    yield session
    session.stop()
