import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def conf(spark):
    """Set Spark SQL settings for one test."""
    changed = {}

    def put(name, value):
        changed.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows(df):
    """Rows as plain tuples in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
