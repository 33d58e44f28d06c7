import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TESTS = os.path.join(ROOT, "tests")
sys.path[:0] = [ROOT, TESTS]
# Python workers import what the tests hand to a data source.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, TESTS, os.environ.get("PYTHONPATH", "")])

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("temblor-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def events(spark, sf_dir):
    """Clean events with country and hazard level, cached for the session."""
    from temblor.operators.hazard import classify_hazard
    from temblor.plans.quakes import placed_quakes

    df = classify_hazard(placed_quakes(spark, sf_dir)).cache()
    df.count()
    return df
