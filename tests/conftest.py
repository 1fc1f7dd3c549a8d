import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="strata-tests", shuffle_partitions=4, extra={
        "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-wh-"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-ckpt-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="strata-test-")
