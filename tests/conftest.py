import pytest

from citysignal.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        if columns:
            df = df.select(*columns)
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
