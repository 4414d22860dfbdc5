"""Deliveries in any order give the versions of the whole log."""

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from foreledger.operators import timeline
from foreledger.operators.versioning import LAST_SEEN, scd2_from_log, scd2_merge
from foreledger.streaming.ingest import RAW_SCHEMA
from tests.conftest import sorted_rows

T = dt.datetime
LOG = """id bigint, data_from_dttm timestamp_ntz, data_to_dttm timestamp_ntz, forecast_intensity int,
    actual_intensity int, index_forecast string, index_actual string, created_at timestamp_ntz"""
ROW = LOG.replace("id bigint, ", "").replace("created_at", "src_processed_dttm")


def observed(n, minute, forecast, label="low", actual=None, period=0):
    start = T(2024, 1, 1, 10) + dt.timedelta(minutes=30 * period)
    stamp = T(2024, 1, 1) + dt.timedelta(minutes=minute)
    return (n, start, start + dt.timedelta(minutes=30), forecast, actual, label, label, stamp)


def deliver(spark, cfg, batches, **how):
    held = timeline.empty(spark.createDataFrame([], RAW_SCHEMA))
    for batch in batches:
        rows = spark.createDataFrame(batch, LOG).withColumnRenamed("created_at", "src_processed_dttm")
        held = timeline.insert(held, rows, cfg, **how)
    return held


def test_any_permutation_equals_the_log(spark, cfg):
    rnd = random.Random(3)
    rows = [
        observed(n, rnd.choice([n, 7]), rnd.choice([100, 110]), rnd.choice(["low", "LOW"]),
                 rnd.choice([None, 90]), n % 3)
        for n in range(24)
    ]
    want = sorted_rows(scd2_from_log(spark.createDataFrame(rows, LOG), cfg))
    for _ in range(3):
        rnd.shuffle(rows)
        cut = sorted(rnd.sample(range(1, 24), 2))
        batches = [rows[a:b] for a, b in itertools.pairwise([0, *cut, 24])]
        held = deliver(spark, cfg, [*batches, batches[0]])
        assert sorted_rows(held.versions) == want
        both = held.versions.select("id").unionByName(held.confirmed.select("id"))
        assert sorted(r.id for r in both.collect()) == list(range(24))


def test_late_row_splits_a_version(spark, cfg):
    """A at 1 and 3, then B made at 2: three versions, the newest forecast open."""
    a1, a3, b2 = observed(1, 1, 100), observed(3, 3, 100), observed(2, 2, 250)
    for order in itertools.permutations([a1, a3, b2]):
        got = deliver(spark, cfg, [[r] for r in order]).versions.orderBy("valid_from_dttm").collect()
        assert [r.forecast_intensity for r in got] == [100, 250, 100]
        assert [r.valid_to_dttm.year for r in got] == [2024, 2024, 5999]


def test_load_time_marks_what_a_load_changed(spark, cfg):
    now = T(2024, 1, 5)
    held = deliver(spark, cfg, [[observed(1, 1, 100), observed(9, 1, 70, period=4)]], now=T(2024, 1, 2))
    late = spark.createDataFrame([observed(2, 5, 250)], LOG)
    held = timeline.insert(held, late.withColumnRenamed("created_at", "src_processed_dttm"), cfg, now)
    stamps = {r.id: r.processed_dttm for r in held.versions.collect()}
    assert stamps == {1: now, 2: now, 9: T(2024, 1, 2)}


def test_one_row_per_moment_in_any_order(spark, cfg):
    pair = [observed(1, 1, 100), observed(2, 1, 250)]
    for order in (pair, pair[::-1]):
        got = deliver(spark, cfg, [[r] for r in order], one_per_stamp=True).versions.collect()
        assert [r.forecast_intensity for r in got] == [250]


def test_confirmed_version_is_not_overtaken(spark):
    """scd2_merge with a last-seen stamp: the newest forecast ends open in every order that confirms it."""
    empty = spark.createDataFrame([], RAW_SCHEMA + f", {LAST_SEEN} timestamp_ntz")
    a1, a3, b2 = observed(1, 1, 100), observed(3, 3, 100), observed(2, 2, 250)
    for order in itertools.permutations([a1, a3, b2]):
        table = empty
        for row in order:
            table = scd2_merge(table, spark.createDataFrame([row[1:]], ROW), row[-1])
        opened = table.filter(F.year("valid_to_dttm") == 5999).collect()
        assert [r.forecast_intensity for r in opened] == [100]
        assert opened[0][LAST_SEEN] == a3[-1]
