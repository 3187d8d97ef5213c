import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_SF = "/root/testdata/sf0.001"
CHECK_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from learnlog.session import LOCAL_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[*]").appName("learnlog-tests")
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="learnlog-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
