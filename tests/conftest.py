import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hitledger.session import RECOMMENDED

    builder = SparkSession.builder.master("local[8]").appName("tests")
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def log_folder(spark, sf_dir, tmp_path_factory):
    """The rendered lines as files."""
    from hitledger.plans.rendered import events, render_lines

    path = str(tmp_path_factory.mktemp("logs") / "lines")
    render_lines(events(spark, sf_dir)).select("value").write.text(path)
    return path


@pytest.fixture(scope="session")
def plan_of():
    def text(df):
        return df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )

    return text
