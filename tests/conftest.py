import os
import sys
import tempfile

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tickloom-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sql(sf_dir):
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        if name.endswith(".parquet"):
            connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection


RAW_ROW = {
    "symbol": "AAPL",
    "timestamp": "2024-01-02",
    "open_price": 10.0,
    "high_price": 12.0,
    "low_price": 9.0,
    "close_price": 11.0,
    "adjusted_close": 11.0,
    "volume": 100,
    "dividend_amount": 0.0,
    "split_coefficient": 1.0,
}


@pytest.fixture(scope="session")
def raw(spark):
    """Make raw bars from rows that differ from a valid bar only in what is given."""
    from tickloom.schema import RAW_SCHEMA

    def make(*rows):
        return spark.createDataFrame([tuple({**RAW_ROW, **r}[c] for c in RAW_SCHEMA.names) for r in rows], RAW_SCHEMA)

    return make


@pytest.fixture(scope="session")
def closes(spark):
    """Make dated bars of one symbol from closes."""
    from datetime import date, timedelta

    def make(values, symbol="TEST", start=date(2024, 1, 1)):
        rows = [(symbol, start + timedelta(days=i), v, 1000) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "symbol string, trade_date date, close_price double, volume long")

    return make
