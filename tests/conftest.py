import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from boardweave.plans.session import BUILDER_CONF, tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config(map=BUILDER_CONF)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def bronze_of(spark):
    from boardweave.sources.landing import BRONZE_FIELDS
    ddl = ", ".join(f"`{n}` {k}" for n, k in BRONZE_FIELDS.items())

    def build(*rows):
        return spark.createDataFrame([tuple(r.get(n) for n in BRONZE_FIELDS) for r in rows], ddl)
    return build
