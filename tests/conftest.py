import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidefold.session import local_session, shared_dir  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tidefold-tests", "4")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from tidefold.session import scratch_path

    return scratch_path(spark, "test")


@pytest.fixture(scope="session")
def data():
    return DATA


def rows(df, *columns):
    """Rows as sorted tuples, NULLs last."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
