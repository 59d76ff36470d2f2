import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from voltspan.session import local_session

    session = local_session(4, "voltspan-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
