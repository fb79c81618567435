import os
import sys

import pytest

HERE = os.path.dirname(__file__)
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from tidewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4)
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
