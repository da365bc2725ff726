import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ranklift.session import get_spark
    os.environ.setdefault("RANKLIFT_DRIVER_MEMORY", "8g")
    s = get_spark("local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ranklift-test-")


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
