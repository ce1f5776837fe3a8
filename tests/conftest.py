import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL_SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyhall.session import get_session
    s = get_session(master="local[8]", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g"})
    yield s
