from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for p in (ROOT, ROOT / "tests"):
    if str(p) not in sys.path:
        sys.path.insert(0, str(p))


@pytest.fixture(scope="session")
def spark():
    from weftline.session import get_session, show_package

    s = get_session("local[8]", shuffle_partitions=4, memory="6g")
    show_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return "/root/testdata/sf0.001"
