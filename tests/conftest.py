import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ.setdefault("PYSPARK_DRIVER_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    b = (SparkSession.builder.master("local[4]").appName("aurum-tests")
         .config("spark.driver.memory", "4g")   # one session runs all tests
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder only when the session names none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aurum-tests-"))
    yield s


@pytest.fixture()
def scratch(spark):
    from aurum.session import shared_path
    return shared_path(spark, "tests")
