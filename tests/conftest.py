import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from genoflux.session import DEFAULT_CONF
    b = SparkSession.builder.master("local[4]").appName("genoflux-tests")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = "8"
    for k, v in conf.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="genoflux-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="genoflux-test-")
