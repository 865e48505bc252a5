import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="strata-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-test-ckpt-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-test-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="strata-test-")
