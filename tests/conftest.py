import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from periodload.session import local_session

    s = local_session("*", shuffle_partitions=8, app="periodload-tests")
    yield s
    s.stop()


@pytest.fixture()
def db(spark):
    from periodload.scenarios import scratch_db

    return scratch_db(spark)
