"""Every registered query against its SQL twin, and the wide shapes against the same SQL."""

import pytest

from __spark_entry__ import entry
from foreledger.plans.registry import QUERIES
from oracles import build
from tests.conftest import SMALL
from tools.check import compare

SQL = build()

# one query per wide operator; the others are made of the same pieces
WIDE = (
    "stg_history",
    "daily_summary",
    "fact",
    "forecast_accuracy",
    "analytics_mart",
    "gap_islands",
    "describe",
)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, db, name):
    text, ok = compare(spark, db, name, QUERIES[name], SQL[name], SMALL)
    assert ok, text


@pytest.mark.parametrize("name", [n for n in WIDE if n in QUERIES])
def test_wide_matches_sql(spark, db, name):
    spark.conf.set("spark.foreledger.wide", "true")
    spark.conf.set("spark.foreledger.bucketRows", "110")
    try:
        text, ok = compare(spark, db, name, QUERIES[name], SQL[name], SMALL)
    finally:
        spark.conf.unset("spark.foreledger.wide")
        spark.conf.unset("spark.foreledger.bucketRows")
    assert ok, text


def test_entry_returns_days(spark):
    assert entry(spark).count() > 0
