import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from harvestry.session import local_session

    s = local_session(8, 8, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from harvestry.session import release

    release(s)


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"
