import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

EVENT_LOG_DIR = tempfile.mkdtemp(prefix="windowlens-eventlog-")


@pytest.fixture(scope="session")
def spark():
    from windowlens.session import build_session
    session = build_session(
        "local[*]", app_name="windowlens-tests", shuffle_partitions=8,
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": EVENT_LOG_DIR,
               "spark.eventLog.compress": "false"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="session")
def event_log_dir():
    return EVENT_LOG_DIR
