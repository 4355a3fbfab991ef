import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from waka.session import BASE_CONF, prepare

    b = SparkSession.builder.master("local[*]").appName("waka-tests").config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if not os.environ.get("SPARK_CHECKPOINT_SET"):
        b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="waka-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    prepare(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from tools.oracle_check import duck as make

    return make
