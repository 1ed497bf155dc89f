import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app="millrace-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from millrace.session import shared_path
    return lambda label="t": shared_path(spark, label)
