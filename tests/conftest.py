import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tunelake.session import local_session

    s = local_session("*", shuffle_partitions=8, app="tunelake-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def lines(spark, tmp_path):
    """Write raw bytes to a text file and return spark.read.text of it."""
    counter = {"n": 0}

    def make(data: bytes):
        counter["n"] += 1
        p = tmp_path / f"in{counter['n']}.txt"
        p.write_bytes(data)
        return spark.read.text(str(p))

    return make
