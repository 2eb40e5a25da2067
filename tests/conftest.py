import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from platelake.session import IMAGE_CONF  # noqa: E402


def make_session():
    builder = (
        SparkSession.builder.master("local[8]").appName("platelake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in IMAGE_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    return make_session()
