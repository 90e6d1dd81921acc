import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tideline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


def rows_of(df, columns=None):
    """Rows as sorted tuples, NULL and NaN told apart."""
    columns = columns or sorted(df.columns)

    def plain(value):
        if isinstance(value, float) and value != value:
            return "NaN"
        return value

    rows = [tuple(plain(row[c]) for c in columns) for row in df.select(*columns).collect()]
    return sorted(rows, key=repr)
