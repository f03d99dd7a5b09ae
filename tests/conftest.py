"""One Spark session for all tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from graphloom.session import local_session

    s = local_session(4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    return s


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test data here")
    return SMALL
