import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pathkin.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "pathkin-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("stages")))
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, doubles rounded."""

    def collect(df, places=6):
        def value(v):
            return round(v, places) if isinstance(v, float) else v

        return sorted((tuple(map(value, r)) for r in df.collect()), key=repr)

    return collect
