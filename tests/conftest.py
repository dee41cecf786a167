import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lakeshelf.session import BASE_CONF

    builder = SparkSession.builder.master("local[4]").appName("lakeshelf-tests")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "4")
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if s.sparkContext.getCheckpointDir() is None and not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeshelf-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
