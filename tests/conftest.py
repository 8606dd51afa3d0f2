import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from starledger.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="starledger-test-ckpt-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="starledger-test-wh-"),
    })
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="starledger-test-")
