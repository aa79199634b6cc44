import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import local_session  # noqa: E402
from shotmarts.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = tune(local_session())
    yield session
    session.stop()
