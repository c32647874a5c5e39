import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from brightloom.session import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", cpus="8")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
