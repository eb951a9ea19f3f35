import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for p in (ROOT, ROOT / "tests"):
    if str(p) not in sys.path:
        sys.path.insert(0, str(p))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from txrisk.session import build_session, ensure_checkpoint_dir

    s = build_session("local[*]", 8, app="txrisk-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
