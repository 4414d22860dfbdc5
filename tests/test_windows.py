"""The wide window shapes equal the plain ones, on a hot key, ties and NULLs."""

import datetime as dt
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from foreledger.operators.joins import left_join_versions
from foreledger.operators.windows import (
    cumulate,
    ordered,
    percentiles,
    top_bottom,
    top_k,
    with_group_stats,
    with_ranks,
)
from foreledger.plans.dwh import (
    with_daily_ranks,
    with_error_windows,
    with_horizon_error,
    with_series_windows,
    with_weekly_error,
    with_weekly_range,
)
from foreledger.plans.marts import with_day_comparison
from tests.conftest import sorted_rows


@pytest.fixture(scope="module")
def rows(spark):
    """600 rows; half of them under one key, some keys of one row, NULL values and a NULL key."""
    return (
        spark.range(600)
        .select(
            "id",
            F.when(F.col("id") % 2 == 0, 0)
            .when(F.col("id") % 97 == 1, F.col("id"))
            .when(F.col("id") % 31 == 1, None)
            .otherwise(F.col("id") % 5)
            .alias("k"),
            ((F.col("id") * 7919) % 600).alias("o"),
            F.when(F.col("id") % 11 != 0, (F.col("id") * 31) % 13).cast("int").alias("v"),
        )
        .cache()
    )


def both(cfg, size=17, limit=0):
    """Plain and wide settings; a limit of 0 makes histograms wide as well."""
    return cfg, replace(cfg, wide=True, bucket_rows=size, plain_limit_bytes=limit)


@pytest.mark.parametrize("size", [3, 17, 1000])
def test_ordered(rows, cfg, size):
    frames = {
        "mean": lambda w: F.avg("v").over(w.rowsBetween(-9, 0)),
        "prev": lambda w: F.lag("v", 2).over(w),
        "next": lambda w: F.lead("v").over(w),
        "around": lambda w: F.sum("o").over(w.rowsBetween(-4, 3)),
    }
    order = [F.col("o").desc()]
    plain, wide = (
        ordered(rows, ["k"], order, frames, c, before=9, after=3, number="no")
        for c in both(cfg, size)
    )
    assert sorted_rows(plain) == sorted_rows(wide)


def test_ordered_without_keys(rows, cfg):
    frames = {"mean": lambda w: F.avg("v").over(w.rowsBetween(-47, 0))}
    plain, wide = (
        ordered(rows, [], [F.col("o").asc()], frames, c, before=47) for c in both(cfg)
    )
    assert sorted_rows(plain) == sorted_rows(wide)


def test_cumulate(rows, cfg):
    plain, wide = (
        cumulate(rows, ["k"], [F.col("o").asc()], {"total": F.col("o")}, c, number="no")
        for c in both(cfg)
    )
    assert sorted_rows(plain) == sorted_rows(wide)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_ranks(rows, cfg, limit):
    kinds = {
        "r": ("rank", True),
        "r_up": ("rank", False),
        "d": ("dense_rank", True),
        "d_up": ("dense_rank", False),
        "p": ("percent_rank", False),
        "p_down": ("percent_rank", True),
    }
    plain, wide = (with_ranks(rows, ["k"], "v", kinds, c) for c in both(cfg, 4, limit))
    assert sorted_rows(plain) == sorted_rows(wide)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_percentiles(rows, cfg, limit):
    points = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    plain, wide = (percentiles(rows, ["k"], "v", points, c) for c in both(cfg, 4, limit))
    assert sorted_rows(plain) == sorted_rows(wide)


def test_group_stats(rows, cfg):
    aggs = {"n": F.count(F.lit(1)), "top": F.max("v"), "mean": F.avg("v")}
    plain, wide = (with_group_stats(rows, ["k"], aggs, c) for c in both(cfg))
    assert sorted_rows(plain) == sorted_rows(wide)


def test_left_join_versions(spark, rows, cfg):
    periods = spark.range(8).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    versions = rows.select("k", F.col("id").alias("key"), "v")
    plain, wide = (left_join_versions(periods, versions, "k", "key", c) for c in both(cfg))
    assert sorted_rows(plain) == sorted_rows(wide)
    assert plain.filter("k = 7").count() == 1  # no version, still there once


def test_day_lags_by_date(spark):
    days = spark.createDataFrame(
        [(dt.date(2024, 1, d), float(d)) for d in (1, 2, 4, 9)], "data_date date, avg_forecast double"
    )
    got = {r.data_date.day: r for r in with_day_comparison(days, by_date=True).collect()}
    assert [got[d].prev_day_avg for d in (1, 2, 4, 9)] == [None, 1.0, None, None]
    assert got[9].prev_week_same_day_avg == 2.0
    rows = {r.data_date.day: r for r in with_day_comparison(days).collect()}
    assert [rows[d].prev_day_avg for d in (1, 2, 4, 9)] == [None, 1.0, 2.0, 4.0]


def test_top_bottom(rows, cfg):
    plain, wide = (top_bottom(rows, ["k"], "v", [F.col("id").asc()], c) for c in both(cfg))
    assert sorted_rows(plain) == sorted_rows(wide)
    top = top_k(rows, ["k"], "v", [F.col("id").asc()], 2).filter("side = 'low'").drop("side", "rnk")
    assert sorted_rows(top) == sorted_rows(plain.filter("rnk_low <= 2").drop("rnk", "rnk_low"))


@pytest.fixture(scope="module")
def versions(spark):
    """300 versions, some of the same period and moment, most of one kind, with NULL values and a NULL kind."""
    n = F.col("id")
    begin = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    made = begin + F.make_dt_interval(mins=(n * 37) % 900)
    return (
        spark.range(300)
        .select(
            n.alias("source_id"),
            n.cast("string").alias("fact_key"),
            (begin + F.make_dt_interval(mins=30 * ((n * 7) % 700))).alias("data_from_dttm"),
            made.alias("forecast_made_at"),
            F.when(n != 13, n % 9 == 0).alias("is_current_version"),
            F.when(n % 17 != 0, (n * 31) % 90).cast("int").alias("forecast_intensity"),
            F.when(n % 5 != 0, (n * 29) % 90).cast("int").alias("actual_intensity"),
            F.when(n % 19 != 0, (n % 40).cast("double")).alias("forecast_horizon_hours"),
            F.when(n % 3 == 0, "immediate").otherwise("short_term").alias("forecast_horizon_category"),
            (n % 41).cast("double").alias("absolute_error"),
            ((n % 41) * (n % 41)).cast("double").alias("squared_error"),
            F.when(n % 23 != 0, (n % 29).cast("double")).alias("absolute_percentage_error"),
        )
        .cache()
    )


@pytest.fixture(scope="module")
def middling(spark, tmp_path_factory):
    """A table of some 5 MB, far below the limit of the plain shapes."""
    path = str(tmp_path_factory.mktemp("middling"))
    spark.range(0, 700_000, 1, 2).select(F.xxhash64("id").alias("v")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "step, wide_plan",
    [
        (with_series_windows, "Window .*__bucket"),
        (with_horizon_error, "Window .*__bucket"),
        (with_error_windows, "Window .*__bucket"),
        (with_daily_ranks, "Join"),
        (with_weekly_range, "Join"),
        (with_weekly_error, "Join"),
    ],
)
def test_few_keys_are_split_early(versions, middling, cfg, step, wide_plan):
    """No version kind, band, category, day or week of a middling table is one task's window."""
    sized = replace(cfg, bucket_rows=110).sized_by(middling)
    assert not sized.wide and not cfg.sized_by(versions.limit(3)).wide
    split = step(versions, sized)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(wide_plan, plan)
    for line in plan.splitlines():
        assert "Window " not in line or "__bucket" in line, line
    assert sorted_rows(split) == sorted_rows(step(versions, cfg))
