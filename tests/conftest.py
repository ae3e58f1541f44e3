import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerloom.session import local_session

    session = local_session("8", "tests", str(tmp_path_factory.mktemp("shared")))
    session.conf.set("spark.sql.shuffle.partitions", "8")
    return session
