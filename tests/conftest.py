import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from oracle import session

    from gradus.session import configure

    return configure(session())


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(autouse=True)
def many_partitions(request):
    """Keep small partitions apart, so that unit tests cross their borders."""
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
