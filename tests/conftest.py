import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session

    session = build_session("local[*]", shuffle_partitions=8, app_name="quire-tests",
                            extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="quire-ckpt-")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_smoke():
    return SF_SMOKE
