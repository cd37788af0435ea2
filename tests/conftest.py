import pytest

from sensorgrid.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 4, **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
    })
    yield session
    session.stop()
