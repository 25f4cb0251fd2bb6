import pytest

from simloom import runtime


@pytest.fixture(scope="session")
def spark():
    session = runtime.local_session(4, "tests", spark__driver__memory="4g", spark__sql__shuffle__partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of plain tuples."""

    def get(df):
        return sorted(tuple(r) for r in df.collect())

    return get
