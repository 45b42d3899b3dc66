import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from changeflow.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    # tests own their session: set a shared folder only because none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="changeflow-test-"))
    yield s
    s.stop()
