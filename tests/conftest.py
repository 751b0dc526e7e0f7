import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from annoloom.plans.session import build_session

    session = build_session(
        "annoloom-tests", "local[8]",
        spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__driver__bindAddress="127.0.0.1",
        spark__driver__host="127.0.0.1",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="annoloom-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("ANNOLOOM_SF_DIR", "/root/testdata/sf0.01")
