"""Parquet tables of a folder, one file or directory per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foreledger.session import prepare


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
