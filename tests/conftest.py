from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wellspring.session import local_session, shared_root

    s = local_session(cores=4, shuffle_partitions=4, app="wellspring-tests")
    shared_root(s)  # tests set their own shared folder (the cluster would name one)
    yield s
    s.stop()
