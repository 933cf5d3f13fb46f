import pytest

from tallymark.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, partitions=4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield session
    session.stop()
