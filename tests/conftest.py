from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session

    session = build_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    if not session.sparkContext.getCheckpointDir():
        # tests only: the cluster names its shared folder in spark.checkpoint.dir
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture()
def scratch(spark):
    from strata.session import run_dir

    return run_dir(spark, "test")
