import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="geoprep-test-ckpt-", dir="/tmp")
    spark = (SparkSession.builder.master("local[*]").appName("geoprep-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.bindAddress", "127.0.0.1")
             .config("spark.driver.host", "127.0.0.1")
             .config("spark.checkpoint.dir", ckpt)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from geoprep.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="geoprep-test-", dir="/tmp")
