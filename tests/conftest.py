import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def column(spark):
    """A one-column frame ``x`` with a row key, spread over a few partitions."""
    def build(values):
        return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)],
                                     "id long, x double").repartition(3)
    return build
