import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from lamina.session import local_session

    SparkSession.builder.config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
