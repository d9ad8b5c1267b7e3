import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ["PYTHONPATH"] = str(Path(__file__).resolve().parent.parent) + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from sedimark.session import local_session

    return local_session(4, 4, "3g")
