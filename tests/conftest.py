import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from souk.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=str)
