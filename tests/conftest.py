import pytest

from folioscope.session import build


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    session = build("local[4]", 4, **folders)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    yield session
    session.stop()
