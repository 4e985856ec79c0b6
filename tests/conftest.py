import pytest

from docloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=8, memory="6g", partitions=8)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    yield session
    session.stop()
