import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from brightwater.session import session

    s = session("local[4]", 4, spark__driver__memory="3g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
