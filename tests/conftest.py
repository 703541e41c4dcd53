import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shopframe.session import build_session
    s = build_session("local[4]", "shopframe-tests", 4,
                      {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="shopframe-test-ckpt-"),
                       "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shopframe-test-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="shopframe-test-")
