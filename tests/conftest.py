import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tabspark.session import DEFAULT_CONF

    builder = SparkSession.builder.master("local[4]").appName("tabspark-tests")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    session = builder.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder only because none is configured here.
    if not session.sparkContext.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabspark-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tabspark-test-")
