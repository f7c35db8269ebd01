import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskview.session import build_session
    ckpt = tempfile.mkdtemp(prefix="riskview-test-ckpt-")
    s = build_session("local[*]", app="riskview-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="riskview-test-")
