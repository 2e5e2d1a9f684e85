import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from retail_mart.session import local_session
    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw_small(spark):
    from retail_mart.sources.fixtures import RawTables
    return RawTables(spark, SF_SMALL)
