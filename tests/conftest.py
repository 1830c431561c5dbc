import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from checks.run import local_session

    session = configure(local_session("4", "4"))
    yield session
    session.stop()


@pytest.fixture
def place(spark, tmp_path):
    return f"file:{tmp_path}"


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
