from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from emberscope.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture()
def fresh():
    """A new directory per test; nothing is cleared away."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
