import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from folioframe.session import SETTINGS
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{folder}/shared", "spark.sql.warehouse.dir": f"{folder}/warehouse",
    }
    session = SparkSession.builder.master("local[4]").appName("tests").config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
