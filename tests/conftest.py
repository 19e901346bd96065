import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martforge.session import get_session
    s = get_session("local[4]", app="martforge-tests",
                    extra={"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="martforge-test-")


@pytest.fixture(scope="session")
def smoke_dir():
    if not os.path.isdir(SMOKE_DIR):
        pytest.skip("test tables not present")
    return SMOKE_DIR
