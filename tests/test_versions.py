"""Versioning: the worked example and the awkward loads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from foreledger.config import OPEN_END
from foreledger.operators.incremental import upsert_counts, upsert_latest
from foreledger.operators.versioning import load_stats, scd2_from_log, scd2_merge
from foreledger.streaming.ingest import RAW_SCHEMA

T = dt.datetime
FROM, TO = T(2024, 1, 1, 10), T(2024, 1, 1, 10, 30)


def batch(spark, *rows):
    return spark.createDataFrame(
        [(FROM, TO, f, a, i, i, at) for f, a, i, at in rows],
        """data_from_dttm timestamp_ntz, data_to_dttm timestamp_ntz, forecast_intensity int,
           actual_intensity int, index_forecast string, index_actual string,
           src_processed_dttm timestamp_ntz""",
    )


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], RAW_SCHEMA)


def versions(df):
    rows = df.orderBy("valid_from_dttm").collect()
    return [
        (r.forecast_intensity, r.actual_intensity, r.valid_from_dttm, r.valid_to_dttm)
        for r in rows
    ]


EXAMPLE = [
    (250, None, T(2024, 1, 1, 8), T(2024, 1, 1, 9, 59, 59)),
    (252, None, T(2024, 1, 1, 10), T(2024, 1, 1, 10, 29, 59)),
    (252, 245, T(2024, 1, 1, 10, 30), OPEN_END),
]


def test_example_from_log(spark, cfg):
    seen = [
        (1, 250, None, T(2024, 1, 1, 8)),
        (2, 250, None, T(2024, 1, 1, 9)),  # unchanged, opens nothing
        (3, 252, None, T(2024, 1, 1, 10)),
        (4, 252, 245, T(2024, 1, 1, 10, 30)),
    ]
    log = spark.createDataFrame(
        [(n, at, FROM, TO, f, a, "high", "high") for n, f, a, at in seen],
        """id bigint, created_at timestamp_ntz, data_from_dttm timestamp_ntz,
           data_to_dttm timestamp_ntz, forecast_intensity int, actual_intensity int,
           index_forecast string, index_actual string""",
    )
    assert versions(scd2_from_log(log, cfg)) == EXAMPLE


def test_example_by_loads(spark, empty):
    table = empty
    for forecast, actual, at, _ in EXAMPLE:
        table = scd2_merge(table, batch(spark, (forecast, actual, "high", at)), at)
    assert versions(table) == EXAMPLE


def test_unchanged_and_replayed_loads_change_nothing(spark, empty):
    first = batch(spark, (250, None, "high", T(2024, 1, 1, 8)))
    once = scd2_merge(empty, first, T(2024, 1, 1, 8))
    again = scd2_merge(once, first, T(2024, 1, 1, 9))
    assert versions(again) == versions(once)


def test_null_to_value_is_a_change(spark, empty):
    table = scd2_merge(empty, batch(spark, (250, None, "high", T(2024, 1, 1))), T(2024, 1, 1))
    table = scd2_merge(table, batch(spark, (250, 240, "high", T(2024, 1, 2))), T(2024, 1, 2))
    assert [v[1] for v in versions(table)] == [None, 240]


def test_key_twice_in_a_batch_opens_one_version(spark, empty):
    two = batch(
        spark, (250, None, "high", T(2024, 1, 1, 8)), (260, None, "high", T(2024, 1, 1, 8, 1))
    )
    assert [v[0] for v in versions(scd2_merge(empty, two, T(2024, 1, 1, 9)))] == [260]


def test_two_loads_in_one_second_keep_order(spark, empty):
    at = T(2024, 1, 1, 8)
    table = scd2_merge(empty, batch(spark, (250, None, "high", at)), at)
    table = scd2_merge(table, batch(spark, (251, None, "high", at)), at)
    assert table.filter("valid_to_dttm < valid_from_dttm").count() == 0
    assert table.filter(F.col("valid_to_dttm") == F.lit(OPEN_END)).count() == 1


def test_load_stats(spark, empty):
    one = batch(spark, (250, None, "high", T(2024, 1, 1, 8)))
    table = scd2_merge(empty, one, T(2024, 1, 1, 8))
    same = load_stats(table, one).first()
    assert (same.extracted, same.loaded, same.transfer_ok) == (1, 0, False)
    none = load_stats(table, one.filter("false")).first()
    assert none.transfer_ok
    new = load_stats(empty, one).first()
    assert (new.inserted, new.reversioned, new.transfer_ok) == (1, 0, True)


def test_upsert_replaces_whole_document(spark):
    schema = "k int, created_at timestamp_ntz, v struct<a:int,b:int>"
    old = spark.createDataFrame([(1, T(2024, 1, 1), (1, 2)), (2, T(2024, 1, 1), (3, 4))], schema)
    new = spark.createDataFrame([(2, T(2024, 1, 2), (None, 5)), (3, T(2024, 1, 2), (6, 7))], schema)
    got = {r.k: tuple(r.v) for r in upsert_latest(old, new, ["k"], ["created_at"]).collect()}
    assert got == {1: (1, 2), 2: (None, 5), 3: (6, 7)}
    counts = upsert_counts(old, new, ["k"]).first()
    assert (counts.inserted, counts.modified, counts.saved) == (1, 1, 2)


def test_overtaken_delivery_changes_nothing(spark, empty):
    """The same two batches in either order leave the newer forecast open, and no overlap."""
    early = batch(spark, (111, None, "low", T(2024, 1, 8, 8)))
    late = batch(spark, (250, None, "high", T(2024, 1, 8, 12)))
    table = scd2_merge(empty, late, T(2024, 1, 8, 12))
    table = scd2_merge(table, early, T(2024, 1, 8, 8))
    assert versions(table) == [(250, None, T(2024, 1, 8, 12), OPEN_END)]
    # a newer row in a load with an older clock starts where the open version does
    table = scd2_merge(table, batch(spark, (260, None, "high", T(2024, 1, 8, 13))), T(2024, 1, 8, 9))
    assert [v[0] for v in versions(table.filter(F.col("valid_to_dttm") == F.lit(OPEN_END)))] == [260]
    assert table.filter("valid_to_dttm < valid_from_dttm").count() == 0
    assert table.agg(F.min("valid_from_dttm")).first()[0] == T(2024, 1, 8, 12)
