import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postlake.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app_name="postlake-tests")
    yield session


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
