from __future__ import annotations

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import SparkSession

from foreledger.config import Settings
from foreledger.session import configure

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        configure(SparkSession.builder)
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def db():
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SMALL}/{file}'")
    return con


@pytest.fixture
def cfg():
    return Settings(as_of=dt.datetime(2024, 2, 1))


def sorted_rows(df, cols=None):
    cols = sorted(cols or df.columns)
    rows = [tuple(_plain(v) for v in r) for r in df.select(*cols).collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value
