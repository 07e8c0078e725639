import pytest

from lakequality import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Rows of a DataFrame as dictionaries, sorted by the named columns."""

    def read(df, *order):
        return [row.asDict(recursive=True) for row in (df.orderBy(*order) if order else df).collect()]

    return read
