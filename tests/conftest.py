from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tillroll.session import RECOMMENDED_CONF  # noqa: E402

ORACLE_SF = "/root/testdata/sf0.01"
SMOKE_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[*]").appName("tillroll-tests")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    session = builder.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def oracle_sales(spark):
    """Sale lines of the sf0.01 tables, computed once for the session."""
    from tillroll.sources.tables import sales_from_tables

    sales = sales_from_tables(spark, ORACLE_SF).cache()
    sales.count()
    yield sales
    sales.unpersist()


@pytest.fixture(scope="session")
def duck():
    from compare import duckdb_connection

    return duckdb_connection(ORACLE_SF)
