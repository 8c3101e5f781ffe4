import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import cloudpickle

import sonoledger
from sonoledger.session import CHECKPOINT_KEY, build_session

cloudpickle.register_pickle_by_value(sonoledger)


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            CHECKPOINT_KEY: f"{scratch}/shared",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
