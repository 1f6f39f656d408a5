import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from chatloom.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("local[4]", 4, spark__driver__memory="6g", spark__ui__enabled="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
