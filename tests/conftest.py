import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from crease.session import get_session, checkpoint_dir

    s = get_session("crease-tests", master="local[8]", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g",
                           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="crease-test-ckpt-")})
    checkpoint_dir(s)
    yield s
    s.stop()
