"""One Spark session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, app="tests")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        import tempfile

        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-tests-"))
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a result as sorted tuples."""
    def collected(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collected
