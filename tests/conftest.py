import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reelrank.session import build_session, checkpoint_root, drop_scratch

    s = build_session(master="local[8]", shuffle_partitions=8)
    checkpoint_root(s)
    yield s
    drop_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
