import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pitpanel.session import session

    return session("local[4]", partitions=4, memory="4g")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
