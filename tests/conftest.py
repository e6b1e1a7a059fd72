import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from townhall.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "townhall-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__maxMetadataStringLength="2000",  # plans name whole paths, however long the temporary folder's is
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
