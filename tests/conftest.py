import pytest

from scholarlake.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", partitions=4, memory="4g", name="tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
