import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

from sparkmart.operators import group_state, key_directory  # noqa: E402
from sparkmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests", str(tmp_path_factory.mktemp("work")))
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    """Stored states of small tests need few folders."""
    monkeypatch.setattr(key_directory, "BUCKETS", 3)
    monkeypatch.setattr(group_state, "BUCKETS", 3)


@pytest.fixture()
def base(tmp_path):
    return str(tmp_path)
