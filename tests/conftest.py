import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rosterline.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    return local_session(8, memory="4g", app="rosterline-tests", shared=shared)


@pytest.fixture
def rows():
    """The rows of a frame as sorted tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect
