import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from campaignlake.session import build_session

    scratch = tempfile.mkdtemp(prefix="campaignlake-tests-")
    s = build_session("local[*]", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "4g",
    })
    # Tests only: fall back to a local folder when the session names none.
    from campaignlake.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s, fallback=os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
