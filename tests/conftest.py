import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from kithwork.operators import skew  # noqa: E402
from kithwork.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def large(spark):
    """Settings under which no side counts as small."""
    spark.conf.set(skew.BROADCAST_ROWS_SETTING, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset(skew.BROADCAST_ROWS_SETTING)


@pytest.fixture
def skewed(spark):
    """Settings under which small tables have hot keys and long bags."""
    spark.conf.set(skew.MIN_ROWS_SETTING, "10")
    spark.conf.set(skew.BAG_ROWS_SETTING, "15")
    spark.conf.set(skew.BROADCAST_ROWS_SETTING, "0")
    yield spark
    spark.conf.unset(skew.BROADCAST_ROWS_SETTING)
    spark.conf.unset(skew.MIN_ROWS_SETTING)
    spark.conf.unset(skew.BAG_ROWS_SETTING)
