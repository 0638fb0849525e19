import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.session import build_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", {"spark.sql.ui.retainedExecutions": "1", "spark.driver.memory": "12g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return f"{TESTDATA}/sf0.001"
