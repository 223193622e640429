import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    """A fresh scratch folder per test session (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    from tidewater.session import get_session

    # Tests name their own checkpoint folder; on a cluster it comes from the session.
    session = get_session(
        "local[*]", shuffle_partitions=8, extra={"spark.checkpoint.dir": os.path.join(scratch, "checkpoints")}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
