import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reelhouse.session import build_session, checkpoint_dir
    s = build_session("local[*]", app_name="reelhouse-tests", shuffle_partitions=8,
                      extra_conf={"spark.driver.memory": "6g"})
    # Tests own their checkpoint folder only when the session names none.
    if not s.sparkContext.getCheckpointDir() and not s.sparkContext.getConf().get(
            "spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp"))
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
