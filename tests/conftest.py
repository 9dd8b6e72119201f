import pytest

from skein.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", 4, 4, driver_memory="3g", **{"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.default.parallelism": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
