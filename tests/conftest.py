import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from urnalake.session import build_session

    session = build_session("local[8]", shuffle_partitions=8)
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield session
    session.stop()
