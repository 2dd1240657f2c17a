import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, driver_memory="4g")
    # tests run locally: give them their own checkpoint folder when none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tm-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="tm-test-out-")
