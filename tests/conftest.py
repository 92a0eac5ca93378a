import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


@pytest.fixture(scope="session")
def spark():
    from offerwell.session import spark_session

    session = spark_session("tests", "local[8]", 4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
