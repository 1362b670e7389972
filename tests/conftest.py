import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def tables_of(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/{os.environ.get('ORACLE_SF', 'sf0.01')}"


@pytest.fixture(scope="session")
def oracle(sf_dir):
    return tables_of(sf_dir)
