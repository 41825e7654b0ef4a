import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import local_session

    s = local_session("4", shuffle_partitions=8, app="tillroll-tests")
    # Tests set their own shared folder only because none is configured.
    if not s.sparkContext.getConf().get("spark.checkpoint.dir"):
        d = tempfile.mkdtemp(prefix="tillroll-test-ckpt-")
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    from tillroll.sources.fixtures import Fixture

    return Fixture(spark, SF_SMALL)
