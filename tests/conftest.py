from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from duebook.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("duebook-tests", 4, partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return CHECKED


@pytest.fixture(scope="session")
def small():
    return SMALL
