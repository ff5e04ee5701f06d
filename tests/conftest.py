import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="shelfwise-warehouse-", dir="/tmp")
    s = build_session("local[4]", app="shelfwise-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": warehouse})
    checkpoint_dir(s, tempfile.mkdtemp(prefix="shelfwise-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shelfwise-test-", dir="/tmp")
