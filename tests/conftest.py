import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wattframe-test-"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="wattframe-test-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
