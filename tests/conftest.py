import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tierlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tierlake-tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false", spark__sql__maxMetadataStringLength="4000")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables():
    return "/root/testdata/sf0.001"
