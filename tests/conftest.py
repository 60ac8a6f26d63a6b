import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from medallion.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4, app_name="medallion-tests")
    yield s


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]
