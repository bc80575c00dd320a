from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pagevane.session import DEFAULTS, ship_package  # noqa: E402
from pagevane.sources import register  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("pagevane-tests")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    register(session)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a Column expression, given as a function of the column ``c``."""

    def value(function, text):
        df = spark.createDataFrame([(text,)], "c string")
        return df.select(function("c").alias("r")).first()["r"]

    return value


def table(spark, name, sf="sf0.001"):
    return spark.read.parquet(f"{DATA}/{sf}/{name}.parquet")


def plan_of(df) -> str:
    """Physical plan as text, subqueries and all."""
    return df._jdf.queryExecution().executedPlan().toString()
