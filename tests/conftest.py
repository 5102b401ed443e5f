import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from parallax.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    yield local_session(8, 4, "tests")
