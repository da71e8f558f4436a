import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tamarind.session import build

    os.environ.setdefault("TAMARIND_DRIVER_MEMORY", "4g")
    s = build("local[4]", 4)
    yield s
    s.stop()
