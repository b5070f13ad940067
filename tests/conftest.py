import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillmark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(4, "tillmark-tests")
    yield session
    session.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]
