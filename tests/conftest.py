import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from certloom.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="certloom-tests")
    yield s


def one(spark, col, schema=None):
    """Evaluate a single Column over a one-row DataFrame."""
    return spark.range(1).select(col.alias("v")).collect()[0]["v"]
