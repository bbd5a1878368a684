import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from newstape.session import local_session

    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample():
    return SAMPLE
