import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import get_session

    s = get_session(
        master="local[*]",
        shuffle_partitions=8,
        conf={"spark.driver.memory": "8g", "spark.sql.autoBroadcastJoinThreshold": "10MB"},
    )
    s.sparkContext.setLogLevel("ERROR")
    # Only where the environment names no checkpoint folder, use our own.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cw-test-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="cw-test-", dir="/tmp")
