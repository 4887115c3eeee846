import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    master = os.environ.get("QUARRY_TEST_MASTER", "local[4]")
    partitions = int(os.environ.get("QUARRY_TEST_PARTITIONS", "4"))
    s = build_session(master, shuffle_partitions=partitions, app_name="quarry-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="quarry-test-")
