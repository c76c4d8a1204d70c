import os
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(REPO))
os.environ["PYTHONPATH"] = f"{REPO}:{os.environ.get('PYTHONPATH', '')}"

from ledgerweave.session import local_session  # noqa: E402

# columns can only be written while there is a session, so it starts before the tests are collected
_SPARK = local_session(4, "tests", **{"spark.driver.memory": "4g"})


@pytest.fixture(scope="session")
def spark():
    yield _SPARK
    _SPARK.stop()
