import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vaultline.session import get_spark

    # Catalog tables created by tests (bucketed vault targets) live in a
    # scratch warehouse folder, not in the working directory.
    s = get_spark("local[4]", 4, extra_conf={
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="vaultline-test-wh-")})
    # Tests run without a cluster: give them a scratch checkpoint folder.
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="vaultline-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="vaultline-test-")
