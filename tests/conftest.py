import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from admart.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app="admart-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(f"{SF_SMALL}/events.parquet"):
        pytest.skip("test tables not available")
    return SF_SMALL
