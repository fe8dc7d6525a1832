import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from weftline.session import local_session

    return local_session(4, partitions=4, memory="3g")


@pytest.fixture(scope="session")
def sf_dir():
    return SF
