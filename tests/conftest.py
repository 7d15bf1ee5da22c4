import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strata.session import local_session

    s = local_session("*", shuffle_partitions=8, app="strata-tests", driver_memory="4g")
    # Tests own the session, so they set the shared folder where it is unset.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture
def rows(spark):
    """Build a small DataFrame from literal rows and a DDL schema."""
    def make(data, schema):
        return spark.createDataFrame(data, schema)
    return make
