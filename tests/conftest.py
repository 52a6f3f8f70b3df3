import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from whlens.session import build_session, ensure_checkpoint_dir
    wh = tempfile.mkdtemp(prefix="whlens-wh-")
    s = build_session("local[4]", "whlens-tests", shuffle_partitions=8,
                      extra_conf={"spark.driver.memory": "4g", "spark.sql.warehouse.dir": wh,
                                  "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="whlens-ckpt-"),
                                  "spark.driver.extraJavaOptions": f"-Dderby.system.home={wh}"})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="whlens-test-")


@pytest.fixture(scope="module", autouse=True)
def own_stats_database():
    """Two modules make a database of this name and count what is in it: none sees the other's tables."""
    yield
    from pyspark.sql import SparkSession
    if session := SparkSession.getActiveSession():
        session.sql("drop database if exists whl_stats cascade")
