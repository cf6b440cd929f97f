import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[2]").appName("quarry-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from quarry.session import checkpoint_dir
    checkpoint_dir(s)  # the configured folder; a scratch one only where unset
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="quarry-test-")


SF = "/root/testdata/sf0.001"
