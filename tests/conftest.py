import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as plain tuples in a fixed order."""

    def collect(df, *columns):
        out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect
