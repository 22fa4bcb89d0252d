import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", shuffle_partitions=4, memory="4g")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def rows():
    """All rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
