import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rfmlens.session import local_session
    s = local_session("*", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def t01(spark):
    from rfmlens.sources.fixtures import Tables
    return Tables(spark, SF01)


@pytest.fixture(scope="session")
def t001(spark):
    from rfmlens.sources.fixtures import Tables
    return Tables(spark, SF001)
