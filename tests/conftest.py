import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = entry.local_session()
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()


@pytest.fixture
def large_mode(spark):
    """Every operator takes the way it takes on data of any size."""
    spark.conf.set("spark.tablescope.onePassBytes", "0")
    yield
    spark.conf.unset("spark.tablescope.onePassBytes")
