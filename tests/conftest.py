import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cdrlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Frame rows as plain tuples, sorted."""

    def get(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return get
