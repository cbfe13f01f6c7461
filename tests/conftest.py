import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recordsmith.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="recordsmith-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="recordsmith-test-")
