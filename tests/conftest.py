import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


from txlab.session import configured  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        configured(SparkSession.builder.master("local[8]"))
        .appName("txlab-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    session = builder.getOrCreate()
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
