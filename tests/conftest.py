import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starkpi.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def star(spark):
    from starkpi.sources.star import Star
    return Star.from_testdata(spark, SF_SMALL)


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
