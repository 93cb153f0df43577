import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starmart.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def seed(spark):
    from seed import seed_sources
    return seed_sources(spark)


@pytest.fixture(scope="session")
def seed_mart(spark, seed):
    import datetime as dt
    from starmart.plans.fact import build_all
    return build_all(seed, dt.date(2025, 1, 1), calendar="default")
