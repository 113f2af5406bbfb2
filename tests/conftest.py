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
    from packetflow.session import local_session

    # Tests run without a cluster: the checkpoint folder is unset, so set one.
    folder = tempfile.mkdtemp(prefix="packetflow-test-")
    session = local_session(4, shuffle_partitions=8,
                            extra={"spark.checkpoint.dir": folder,
                                   "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true"})
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from packetflow.session import run_folder

    return run_folder(spark, "test")
