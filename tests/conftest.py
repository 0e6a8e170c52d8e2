import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from guestlens.session import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tiny():
    return TINY


@pytest.fixture(scope="session")
def small():
    return SMALL
