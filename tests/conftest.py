import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                            spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                            spark__driver__memory="6g", spark__sql__catalogImplementation="in-memory")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder below the shared one; left to whoever owns that."""
    from tidemark.session import scratch_path

    return scratch_path(spark, "test")
