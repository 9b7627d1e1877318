import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from segmetrics.session import build_session
    extra = {}
    # tests may set their own checkpoint folder; a cluster names a shared one
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="segm-test-ckpt-")
    s = build_session("local[4]", 4, app="segmetrics-tests", driver_memory="4g", extra=extra)
    yield s
    s.stop()


@pytest.fixture
def tmp_out():
    return tempfile.mkdtemp(prefix="segm-test-out-")
